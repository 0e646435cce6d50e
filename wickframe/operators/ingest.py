"""Raw quotes to tick messages: parse, grade, quarantine, encode."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.functions.ordering import sequence_fits
from wickframe.functions.prices import is_numeric, parse_price
from wickframe.schemas import EXACT, RAW_QUOTE, PriceMode

MISSING = "missing"
NON_NUMERIC = "non_numeric"
UNREPRESENTABLE = "unrepresentable"
NO_TIMESTAMP = "no_timestamp"
NO_PAIR = "no_pair"
BAD_SEQUENCE = "bad_sequence"

REASONS = (MISSING, NON_NUMERIC, UNREPRESENTABLE, NO_TIMESTAMP, NO_PAIR, BAD_SEQUENCE)

# What the gate in front of the log turns away. The other reasons come from typed decoding.
GATE_REASONS = (MISSING, NON_NUMERIC)

# The symbol of a raw quote, and up to how many symbols are searched for in its whole text.
SYMBOL_KEY = '"s"'
SYMBOL = SYMBOL_KEY + r'\s*:\s*"([^"]*)"'
SEARCHED = 64

MESSAGE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_json_once(df: DataFrame, text: Column, schema: T.StructType, *keep: str) -> DataFrame:
    """Columns of ``schema`` read from JSON ``text``, next to the ``keep`` columns.

    The parsed struct goes through ``inline`` because filters are not pushed below a generator.
    Below a plain projection each filter on a parsed field would parse the text again.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def parse_raw_quotes(raw: DataFrame, arrival: str | None = None) -> DataFrame:
    """Raw quote text in ``value`` to ``(sequence, pair, bid, ask, timestamp)``.

    Quotes carry no event time: ``arrival`` names the column that recorded it, otherwise the
    current time is stamped. Prices stay text. Quantities are dropped; the update id is kept as
    the sequence that orders quotes of equal time.
    """
    names = {"u": "sequence", "s": "pair", "b": "bid", "a": "ask"}
    schema = T.StructType([RAW_QUOTE[c] for c in names])
    keep = [arrival] if arrival else []
    stamped = F.col(arrival) if arrival else F.current_timestamp()
    # JSON keys differ only in letter case (b/B, a/A), columns are matched by name after renaming.
    quotes = parse_json_once(raw, F.col("value").cast("string"), schema, *keep)
    return quotes.select(
        *(F.col(old).alias(new) for old, new in names.items()),
        stamped.cast("timestamp_ntz").alias("timestamp"),
    )


def may_mention(raw: DataFrame, pairs: Iterable[str]) -> DataFrame:
    """Raw messages that can be quotes of some pairs: a plain text test, to parse fewer of them.

    Few pairs are searched for one by one. Of many, the symbol is cut out of the text once and looked up in a
    hashed set, so neither plan nor cost grows with their number. What the text alone cannot tell always
    passes (escapes, a key that comes twice, a symbol that is no text); ``only_pairs`` decides.
    """
    wanted = sorted({p.lower() for p in pairs})
    text = F.col("value").cast("string")
    escaped = text.contains("\\")
    if len(wanted) <= SEARCHED:
        return raw.filter(reduce(or_, [F.lower(text).contains(pair) for pair in wanted], escaped))
    symbol = F.regexp_extract(text, SYMBOL, 1)
    once = F.length(F.replace(text, F.lit(SYMBOL_KEY), F.lit(""))) == F.length(text) - len(SYMBOL_KEY)
    return raw.filter(F.lower(symbol).isin(wanted) | (symbol == "") | ~once | escaped)


def only_pairs(quotes: DataFrame, pairs: Iterable[str]) -> DataFrame:
    """Keep a set of pairs, given in any letter case."""
    return quotes.filter(F.lower("pair").isin(sorted({p.lower() for p in pairs})))


def quality_reason(bid: Column, ask: Column, mode: PriceMode = EXACT) -> Column:
    """Why a tick is rejected, NULL when it is good.

    A price that parses as a decimal is numeric as well, so the pattern is tried on the rest only.
    """
    fits = parse_price(bid, mode).isNotNull() & parse_price(ask, mode).isNotNull()
    return (
        F.when(bid.isNull() | ask.isNull(), MISSING)
        .when(fits, F.lit(None).cast("string"))
        .when(is_numeric(bid) & is_numeric(ask), UNREPRESENTABLE)
        .otherwise(NON_NUMERIC)
    )


def grade(
    ticks: DataFrame, mode: PriceMode = EXACT, sequence_limit: int | None = None
) -> DataFrame:
    """Add ``reason``: price faults first, then a missing time or pair, then a sequence over the limit."""
    return ticks.withColumn(
        "reason",
        F.coalesce(
            quality_reason(F.col("bid"), F.col("ask"), mode),
            F.when(F.col("timestamp").isNull(), NO_TIMESTAMP),
            F.when(F.col("pair").isNull(), NO_PAIR),
            F.when(~sequence_fits(F.col("sequence"), sequence_limit), BAD_SEQUENCE),
        ),
    )


def passes_gate(reason: Column) -> Column:
    """Whether the gate in front of the log lets the tick through."""
    return ~F.coalesce(reason, F.lit("")).isin(*GATE_REASONS)


def accepted(graded: DataFrame) -> DataFrame:
    """Ticks the gate forwards to the log."""
    return graded.filter(passes_gate(F.col("reason"))).drop("reason")


def quarantined(graded: DataFrame) -> DataFrame:
    """Every tick that cannot reach a candle, with its content and the reason."""
    return graded.filter(F.col("reason").isNotNull())


def quality_summary(graded: DataFrame) -> DataFrame:
    """Ticks per reason; good ones count as ``accepted``."""
    return graded.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("ticks")
    )


def reason_counts() -> list[Column]:
    """An aggregate for each reason and for good ticks, as :func:`quality_summary` has them in rows."""
    good = F.count_if(F.col("reason").isNull()).alias("accepted")
    return [good, *(F.count_if(F.col("reason").eqNullSafe(r)).alias(r) for r in REASONS)]


def _message_body(with_sequence: bool = False) -> Column:
    time = F.date_format("timestamp", MESSAGE_TIME_FORMAT)
    sequence = ["sequence"] if with_sequence else []
    return F.to_json(F.struct("bid", "ask", "pair", time.alias("timestamp"), *sequence))


def encode_messages(ticks: DataFrame, with_sequence: bool = False) -> DataFrame:
    """Ticks to log messages: key = pair, value = JSON with the prices as they were sent.

    ``sequence`` and ``timestamp`` ride along for sinks that keep them. A topic keeps key and value
    only, and its offsets are in no order when several tasks write: there the sequence goes into the
    value too. No repartitioning by pair is needed then (one pair may be most of the feed).
    """
    return ticks.select(
        F.col("pair").alias("key"),
        _message_body(with_sequence).alias("value"),
        "sequence",
        "timestamp",
    )


def gate_log(quotes: DataFrame, mode: PriceMode = EXACT, partition: int = 0) -> DataFrame:
    """Graded quotes as log rows, with ``reason`` and whether the gate ``passed`` them.

    Log and rejects come out of one pass over the quotes; sinks split them by ``passed``.
    """
    graded = grade(quotes, mode)
    return graded.select(
        F.col("pair").alias("key"),
        _message_body().alias("value"),
        F.lit(partition).cast("int").alias("partition"),
        F.col("sequence").alias("offset"),
        "timestamp",
        "reason",
        passes_gate(F.col("reason")).alias("passed"),
    )
