"""Open/high/low/close candles over sliding event-time windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.functions.durations import micros, pane_micros
from wickframe.functions.ordering import (
    epoch_micros,
    moved_key,
    order_key,
    rescaled_key,
    sequence_fits,
    wide_order_key,
)
from wickframe.schemas import CANDLE_COLUMNS
from wickframe.session import require_utc

SIZE = "5 minutes"
SLIDE = "1 minute"

# Columns that candles may have beside their own.
MORE = ("newest_tick", "open_rank", "close_rank")

# Windows that overlap more often than this are swept; fewer are quicker by copies of their panes.
COPIES = 8


def assign_windows(
    ticks: DataFrame, size: str = SIZE, slide: str = SLIDE, time: str = "timestamp"
) -> DataFrame:
    """One row per tick and window it falls in; ``window`` is ``[start, end)`` on epoch multiples.

    Rows without a time fall in no window and disappear.
    """
    return ticks.withColumn("window", F.window(time, size, slide))


def window_bounds(assigned: DataFrame) -> DataFrame:
    """Replace ``window`` by its bounds."""
    return assigned.select(
        *(c for c in assigned.columns if c != "window"),
        F.col("window.start").alias("open_time"),
        F.col("window.end").alias("close_time"),
    )


def _mid_in_order(sequence_limit: int | None) -> Column:
    """The mid price of ticks that can be ordered under the limit; the others count for no price."""
    mid = F.col("mid_price")
    return mid if sequence_limit is None else F.when(sequence_fits(F.col("sequence"), sequence_limit), mid)


def _ohlc(
    assigned: DataFrame,
    start: str,
    by: str,
    span: int,
    sequence_limit: int | None,
    keep_null_mids: bool,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """OHLC of ticks per pair and column ``by``, open and close by time and then sequence; ``more`` beside them.

    ``start`` is where the window of ``span`` microseconds begins.

    Ticks without a mid get no order key, which min_by/max_by skip just as min/max skip the NULL
    itself. That replaces a filter, and groups without any mid or without a pair are removed after
    the aggregation. Ticks outside the sequence limit have no mid. Sequences are BIGINT, or without a limit
    DECIMALs of any width.
    """
    require_utc(assigned)
    wide = sequence_limit is None and isinstance(assigned.schema["sequence"].dataType, T.DecimalType)
    if wide:
        key = wide_order_key(F.col("timestamp"), F.col(start), F.col("sequence"))
    else:
        key = order_key(F.col("timestamp"), F.col(start), span, F.col("sequence"), sequence_limit)
    if not keep_null_mids:
        key = F.when(F.col("mid_price").isNotNull(), key)
    bars = (
        assigned.withColumns({"rank": key, "mid_price": _mid_in_order(sequence_limit)})
        .groupBy("pair", by)
        .agg(
            F.min_by("mid_price", "rank").alias("open_price"),
            F.max("mid_price").alias("high_price"),
            F.min("mid_price").alias("low_price"),
            F.max_by("mid_price", "rank").alias("close_price"),
            *(column.alias(name) for name, column in (more or {}).items()),
        )
    )
    if keep_null_mids:
        return bars
    return bars.filter(F.col("open_price").isNotNull() & F.col("pair").isNotNull())


def _as_candles(bars: DataFrame) -> DataFrame:
    named = window_bounds(bars.withColumnRenamed("pair", "currency_pair"))
    return named.select(
        *(
            F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_time") else F.col(c)
            for c in CANDLE_COLUMNS
        ),
        *(c for c in bars.columns if c in MORE),
    )


def candles_direct(
    mids: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    sequence_limit: int | None = None,
    keep_null_mids: bool = False,
    newest_tick: bool = False,
    ranks: bool = False,
) -> DataFrame:
    """Candles in one aggregation. Works on streams; expands each tick to size/slide windows.

    With ``newest_tick`` each has the time of its newest tick in a column of that name, with ``ranks`` the order
    keys of its first and last tick, so that ticks that come later can be merged into it.
    """
    assigned = assign_windows(mids, size, slide)
    more = {"newest_tick": F.max("timestamp")} if newest_tick else {}
    if ranks:
        more |= {
            "open_rank": rescaled_key(F.min("rank"), sequence_limit),
            "close_rank": rescaled_key(F.max("rank"), sequence_limit),
        }
    bars = _ohlc(assigned, "window.start", "window", micros(size), sequence_limit, keep_null_mids, more)
    return _as_candles(bars)


def panes(
    mids: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    sequence_limit: int | None = None,
    keep_null_mids: bool = False,
) -> DataFrame:
    """OHLC per pair and tumbling pane, the widest that tiles all ``size``/``slide`` windows.

    Each tick is aggregated once, on the map side first, so a hot pair or minute shuffles as one
    row per task. Stored panes can be rolled up again without reading ticks.
    """
    width = pane_micros(size, slide)
    pane = F.window("timestamp", f"{width} microseconds")
    assigned = mids.withColumn("pane_start", pane.getField("start"))
    return _ohlc(assigned, "pane_start", "pane_start", width, sequence_limit, keep_null_mids)


def partial_panes(
    mids: DataFrame, width: str = SLIDE, *, sequence_limit: int | None = None
) -> DataFrame:
    """Panes of some of the ticks, with the order keys of open and close, to be merged later.

    Keys are stored in one scale, so parts made with different sequence limits can be merged.
    """
    require_utc(mids)
    span = micros(width)
    start = F.window("timestamp", width).getField("start")
    key = order_key(
        F.col("timestamp"), F.col("pane_start"), span, F.col("sequence"), sequence_limit
    )
    bars = (
        mids.withColumn("pane_start", start)
        .withColumns(
            {
                "rank": F.when(F.col("mid_price").isNotNull(), key),
                "mid_price": _mid_in_order(sequence_limit),
            }
        )
        .groupBy("pair", "pane_start")
        .agg(
            F.min_by("mid_price", "rank").alias("open_price"),
            F.min("rank").alias("open_rank"),
            F.max("mid_price").alias("high_price"),
            F.min("mid_price").alias("low_price"),
            F.max_by("mid_price", "rank").alias("close_price"),
            F.max("rank").alias("close_rank"),
        )
        .filter(F.col("open_price").isNotNull() & F.col("pair").isNotNull())
    )
    return bars.select(
        *(
            rescaled_key(F.col(c), sequence_limit).alias(c) if c.endswith("_rank") else c
            for c in bars.columns
        )
    )


def merge_panes(parts: DataFrame) -> DataFrame:
    """One pane per pair and start. A part that comes twice changes nothing."""
    return parts.groupBy("pair", "pane_start").agg(
        F.min_by("open_price", "open_rank").alias("open_price"),
        F.min("open_rank").alias("open_rank"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_rank").alias("close_price"),
        F.max("close_rank").alias("close_rank"),
    )


def merge_late(candle_rows: DataFrame, pane_bars: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Candles with ranks, and whole panes of ticks that came too late for them, as the candles of all ticks.

    A tick that is in both counts once. Panes are copied into all windows they lie in; they are few.
    """
    require_utc(candle_rows)
    length, step = micros(size), micros(slide)
    at = epoch_micros(F.col("pane_start"))
    last = at - F.pmod(at, F.lit(step))
    first = at - length + 1
    first = first + F.pmod(-first, F.lit(step))
    opened = pane_bars.withColumn("opens", F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))))
    prices = ["open_price", "high_price", "low_price", "close_price"]
    late = opened.select(
        F.col("pair").alias("currency_pair"),
        F.timestamp_micros("opens").cast("timestamp_ntz").alias("open_time"),
        *prices,
        *(moved_key(F.col(rank), at - F.col("opens")).alias(rank) for rank in ("open_rank", "close_rank")),
    )
    on_time = candle_rows.select("currency_pair", "open_time", *prices, "open_rank", "close_rank")
    bars = (
        on_time.unionByName(late)
        .groupBy("currency_pair", "open_time")
        .agg(
            F.min_by("open_price", "open_rank").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "close_rank").alias("close_price"),
        )
    )
    closes = F.timestamp_micros(epoch_micros(F.col("open_time")) + F.lit(length)).cast("timestamp_ntz")
    return bars.withColumn("close_time", closes).select(*CANDLE_COLUMNS)


def roll_up(pane_bars: DataFrame, size: str = SIZE, slide: str = SLIDE) -> DataFrame:
    """Panes to candles: the first pane's open, the last pane's close, the extremes between.

    Panes are copied into their windows where those are few, and swept where they are many.
    """
    require_utc(pane_bars)
    length, step = micros(size), micros(slide)
    if length > COPIES * step:
        return _as_candles(_swept(pane_bars, length, step))
    # Window starts are generated per pane, so that the plan does not grow with size over slide.
    at = epoch_micros(F.col("pane_start"))
    last = at - F.pmod(at, F.lit(step))
    first = at - length + 1
    first = first + F.pmod(-first, F.lit(step))
    opened = pane_bars.withColumn("opens", F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))))
    window = F.struct(
        F.timestamp_micros("opens").cast("timestamp_ntz").alias("start"),
        F.timestamp_micros(F.col("opens") + F.lit(length)).cast("timestamp_ntz").alias("end"),
    )
    bars = (
        opened.withColumn("window", window)
        .groupBy("pair", "window")
        .agg(
            F.min_by("open_price", "pane_start").alias("open_price"),
            F.max("high_price").alias("high_price"),
            F.min("low_price").alias("low_price"),
            F.max_by("close_price", "pane_start").alias("close_price"),
        )
    )
    return _as_candles(bars)


def _swept(pane_bars: DataFrame, length: int, step: int) -> DataFrame:
    """Bars of all windows at a cost that does not depend on how often they overlap.

    Time is cut into blocks as long as a window. A window that opens at ``s`` is a tail of its own block,
    the panes from ``s`` on, and a head of the next one, the panes before ``s + length``. So each pane is two
    rows of a block: at its own start, where tails begin to lack it, and in the block before at its start
    less the length, where heads begin to have it. In order of these places running values give the tail and
    the head at each of them, and between two places all windows have the same panes. Only then the starts
    between them are written out, one row for each candle. A group is one pair in one block.
    """
    at = epoch_micros(F.col("pane_start"))
    block = F.floor((at - F.pmod(at, F.lit(length))) / F.lit(length)).cast("bigint")
    bar = F.struct("open_price", "high_price", "low_price", "close_price")
    sides = F.array(
        F.struct(block.alias("block"), at.alias("at"), F.lit(True).alias("tail")),
        F.struct((block - 1).alias("block"), (at - length).alias("at"), F.lit(False).alias("tail")),
    )
    places = pane_bars.select("pair", bar.alias("bar"), F.explode(sides).alias("place"))
    places = places.select(
        "pair",
        "place.block",
        "place.at",
        "place.tail",
        F.when(F.col("place.tail"), F.col("bar")).alias("tail_bar"),
        F.when(~F.col("place.tail"), F.col("bar")).alias("head_bar"),
    )
    group = Window.partitionBy("pair", "block")
    rising = group.orderBy("at", "tail")
    # A tail at a place holds the panes from there on; a head holds those of earlier places.
    onward = group.orderBy(F.desc("at"), F.desc("tail")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    through = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(bars: str, over: WindowSpec, backward: bool = False) -> Column:
        first, last = F.first(bars, ignorenulls=True).over(over), F.last(bars, ignorenulls=True).over(over)
        opening, closing = (last, first) if backward else (first, last)
        return F.when(
            opening.isNotNull(),
            F.struct(
                opening["open_price"].alias("open_price"),
                F.max(f"{bars}.high_price").over(over).alias("high_price"),
                F.min(f"{bars}.low_price").over(over).alias("low_price"),
                closing["close_price"].alias("close_price"),
            ),
        )

    swept = places.select(
        "pair",
        "block",
        "at",
        F.lag("at").over(rising).alias("after"),
        F.lead("at").over(rising).alias("next"),
        running("tail_bar", onward, backward=True).alias("tail"),
        running("head_bar", before).alias("head"),
        running("head_bar", through).alias("last_head"),
    )

    def starts(after: Column, until: Column) -> Column:
        """Starts of windows in ``(after, until]``."""
        first = after + 1 + F.pmod(-(after + 1), F.lit(step))
        return F.when(first <= until, F.sequence(first, until, F.lit(step).cast("bigint"))).otherwise(
            F.array().cast("array<bigint>")
        )

    opens = F.col("block") * length
    no_bar = F.lit(None).cast(swept.schema["tail"].dataType)
    until_here = F.struct(
        starts(F.coalesce("after", opens - 1), F.col("at")).alias("opens"),
        F.col("tail").alias("tail"),
        F.col("head").alias("head"),
    )
    # Behind the last place of a block only the head is left.
    to_the_end = F.struct(
        starts(F.col("at"), opens + length - 1).alias("opens"),
        no_bar.alias("tail"),
        F.col("last_head").alias("head"),
    )
    both = F.when(F.col("next").isNull(), F.array(until_here, to_the_end)).otherwise(F.array(until_here))
    spans = swept.select("pair", F.inline(both))
    # Spans without a pane make no candle, nor do those without a start.
    spans = spans.where(F.col("tail").isNotNull() | F.col("head").isNotNull())
    spans = spans.where(F.size("opens") > 0).select(
        "pair",
        "opens",
        F.coalesce("tail", "head")["open_price"].alias("open_price"),
        F.greatest("tail.high_price", "head.high_price").alias("high_price"),
        F.least("tail.low_price", "head.low_price").alias("low_price"),
        F.coalesce("head", "tail")["close_price"].alias("close_price"),
    )
    bars = spans.select("pair", F.explode("opens").alias("open_at"), *spans.columns[2:])
    window = F.struct(
        F.timestamp_micros("open_at").cast("timestamp_ntz").alias("start"),
        F.timestamp_micros(F.col("open_at") + F.lit(length)).cast("timestamp_ntz").alias("end"),
    )
    return bars.select("pair", window.alias("window"), *bars.columns[2:])


def candles(
    mids: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    sequence_limit: int | None = None,
    keep_null_mids: bool = False,
) -> DataFrame:
    """Candles of a batch of mid prices, by panes where windows overlap."""
    options = {"sequence_limit": sequence_limit, "keep_null_mids": keep_null_mids}
    if micros(size) == micros(slide):
        return candles_direct(mids, size, slide, **options)
    return roll_up(panes(mids, size, slide, **options), size, slide)


def low_high(candle_rows: DataFrame) -> DataFrame:
    return candle_rows.select("currency_pair", "open_time", "low_price", "high_price")


def open_close(candle_rows: DataFrame) -> DataFrame:
    return candle_rows.select("currency_pair", "open_time", "open_price", "close_price")
