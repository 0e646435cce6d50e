"""Whole batch plans, from stored input to candles."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.functions.durations import micros
from wickframe.operators import decode, ingest, ohlc
from wickframe.operators.ohlc import SIZE, SLIDE
from wickframe.schemas import EXACT, PriceMode
from wickframe.sources.ticklog import LogSource, between, read_log


def quotes_from_raw(
    raw: DataFrame, arrival: str | None = None, pairs: Iterable[str] | None = None
) -> DataFrame:
    """Raw quote text to quotes, of all pairs or a set of them."""
    if pairs is None:
        return ingest.parse_raw_quotes(raw, arrival)
    chosen = set(pairs)
    return ingest.only_pairs(
        ingest.parse_raw_quotes(ingest.may_mention(raw, chosen), arrival), chosen
    )


def candles_from_raw(
    raw: DataFrame,
    arrival: str | None = None,
    pairs: Iterable[str] | None = None,
    size: str = SIZE,
    slide: str = SLIDE,
    mode: PriceMode = EXACT,
    sequence_limit: int | None = None,
) -> DataFrame:
    """Raw quote text to candles, of all pairs or a set of them."""
    quotes = quotes_from_raw(raw, arrival, pairs)
    mids = decode.mids_from_quotes(quotes, mode)
    return ohlc.candles(mids, size, slide, sequence_limit=sequence_limit)


def candles_from_log(
    log: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    mode: PriceMode = EXACT,
    sequence_limit: int | None = None,
) -> DataFrame:
    """Log messages to candles: the batch twin of the candle stream, for backfills."""
    mids = decode.mids_from_messages(log, mode)
    return ohlc.candles(mids, size, slide, sequence_limit=sequence_limit)


def candles_since(
    spark: SparkSession,
    source: LogSource,
    since: datetime,
    size: str = SIZE,
    slide: str = SLIDE,
    mode: PriceMode = EXACT,
    sequence_limit: int | None = None,
) -> DataFrame:
    """All candles that a tick from ``since`` on can have changed, whole: what to write again after a failure.

    Windows that reach ``since`` open up to ``size`` before it, so the log is read from there on, and windows
    that open earlier are left out, since they would lack ticks.
    """
    first = since - timedelta(microseconds=micros(size) - 1)
    log = read_log(spark, between(source, first))
    candles = candles_from_log(log, size, slide, mode, sequence_limit)
    return candles.filter(F.col("open_time") >= F.lit(first))
