"""One comparable number per tick, so that open and close follow event time and then sequence.

``min_by``/``max_by`` over a struct cannot use hash aggregation and would sort all ticks; a number
can. The number is the time since the window began, scaled, plus the sequence. By default it is a
DECIMAL(38,0) that holds every BIGINT sequence. Callers that know their sequences to lie in
``[0, limit)`` may pass that limit: where the product fits 63 bits the number is a BIGINT, which is
about twice as fast. Sequences wider than BIGINT leave no room for the time in one number; their ticks
are ranked by both in a struct, and sorted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIGINT_END = 2**63
_DECIMAL_END = 10**38
# Any BIGINT, moved up by the lower bound, is below the scale.
_SCALE, _LOWEST = 2**64, 2**63


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def sequence_fits(sequence: Column, sequence_limit: int | None) -> Column:
    """Whether a tick's sequence can be ordered under a limit; a missing one counts as 0."""
    if sequence_limit is None:
        return F.lit(True)
    return F.coalesce(sequence.cast("bigint"), F.lit(0)).between(0, sequence_limit - 1)


def _wide(since: Column, sequence: Column) -> Column:
    # 18 digits hold any span in microseconds, 20 digits the scale and any moved sequence.
    scaled = since.cast("decimal(18,0)") * F.lit(str(_SCALE)).cast("decimal(20,0)")
    moved = sequence.cast("decimal(19,0)") + F.lit(str(_LOWEST)).cast("decimal(19,0)")
    return (scaled + moved).cast("decimal(38,0)")


def order_key(
    ts: Column, start: Column, span_micros: int, sequence: Column, sequence_limit: int | None = None
) -> Column:
    """Rank of a tick within a window of ``span_micros`` that begins at ``start``.

    A missing sequence counts as 0. Under a limit, a sequence outside ``[0, limit)`` has no rank, and
    candles leave its tick out of all prices; ``ingest.grade`` tells which they are.
    """
    since = epoch_micros(ts) - epoch_micros(start)
    seq = F.coalesce(sequence.cast("bigint"), F.lit(0))
    if sequence_limit is None:
        return _wide(since, seq)
    fits = sequence_fits(sequence, sequence_limit)
    if span_micros * sequence_limit <= _BIGINT_END:
        return F.when(fits, since * F.lit(sequence_limit).cast("bigint") + seq)
    if sequence_limit > _BIGINT_END or span_micros * sequence_limit > _DECIMAL_END:
        raise ValueError("sequence_limit is too large for this window size")
    limit = F.lit(str(sequence_limit)).cast("decimal(19,0)")
    key = since.cast("decimal(18,0)") * limit + seq.cast("decimal(19,0)")
    return F.when(fits, key.cast("decimal(38,0)"))


def wide_order_key(ts: Column, start: Column, sequence: Column) -> Column:
    """Rank of a tick whose sequence may be any whole DECIMAL. A missing one counts as 0."""
    since = epoch_micros(ts) - epoch_micros(start)
    return F.struct(since.alias("since"), F.coalesce(sequence, F.lit(0)).alias("sequence"))


def rescaled_key(key: Column, sequence_limit: int | None) -> Column:
    """An order key made with ``sequence_limit``, as one made without."""
    exact = key.cast("decimal(38,0)")
    if sequence_limit is None:
        return exact
    limit = F.lit(str(sequence_limit)).cast("decimal(19,0)")
    sequence = exact % limit
    return _wide(F.floor((exact - sequence) / limit), sequence)


def moved_key(key: Column, micros: Column) -> Column:
    """An order key without limit, of a window that begins so much earlier."""
    moved = micros.cast("decimal(18,0)") * F.lit(str(_SCALE)).cast("decimal(20,0)")
    return (key + moved).cast("decimal(38,0)")
