"""What readers ask of the candle table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickframe.functions.durations import micros
from wickframe.functions.ordering import epoch_micros
from wickframe.operators.ohlc import SIZE
from wickframe.schemas import CANDLE_KEY
from wickframe.session import require_utc


def ordered(candle_rows: DataFrame, limit: int) -> DataFrame:
    """First rows by pair and open time."""
    return candle_rows.orderBy(*CANDLE_KEY).limit(limit)


def latest(candle_rows: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` most recent candles of each pair.

    Spark keeps only ``n`` rows per pair on the map side before it shuffles by pair.
    """
    newest = Window.partitionBy("currency_pair").orderBy(F.desc("open_time"))
    return (
        candle_rows.withColumn("nth", F.row_number().over(newest))
        .filter(F.col("nth") <= n)
        .drop("nth")
    )


def latest_disjoint(candle_rows: DataFrame, n: int = 12, size: str = SIZE) -> DataFrame:
    """The ``n`` most recent candles of each pair that tile time back from its latest one.

    Windows tile when their starts are equal modulo the window size. The newest ``n`` of every
    such class are cut off first, again on the map side, so the step that compares whole pairs to
    find the latest open time sees a bounded number of rows.
    """
    require_utc(candle_rows)
    phase = F.pmod(epoch_micros(F.col("open_time")), F.lit(micros(size)))
    newest = Window.partitionBy("currency_pair", "phase").orderBy(F.desc("open_time"))
    per_class = (
        candle_rows.withColumn("phase", phase)
        .withColumn("nth", F.row_number().over(newest))
        .filter(F.col("nth") <= n)
    )
    whole_pair = Window.partitionBy("currency_pair")
    return (
        per_class.withColumn("latest_phase", F.max_by("phase", "open_time").over(whole_pair))
        .filter(F.col("phase") == F.col("latest_phase"))
        .drop("phase", "latest_phase", "nth")
    )
