"""Log messages to typed ticks and mid prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.functions.prices import mid_price, parse_price
from wickframe.operators.ingest import BAD_SEQUENCE, grade, parse_json_once, quarantined
from wickframe.schemas import EXACT, MESSAGE, PriceMode


def decode_messages(log: DataFrame, mode: PriceMode = EXACT) -> DataFrame:
    """Log rows to ``(sequence, bid, ask, pair, timestamp)`` under the fixed message schema.

    A field that does not parse is NULL and the rest is kept; malformed text gives NULL fields.
    Prices are read as text and parsed like those of raw quotes. The sequence is the message's, or
    the log's offset where the message has none. The log's own timestamp is dropped, the message's
    counts.
    """
    ticks = parse_json_once(
        log.select("offset", "value"), F.col("value").cast("string"), MESSAGE, "offset"
    )
    return ticks.select(
        F.coalesce("sequence", "offset").alias("sequence"),
        parse_price(F.col("bid"), mode).alias("bid"),
        parse_price(F.col("ask"), mode).alias("ask"),
        "pair",
        "timestamp",
    )


def outside_limit(log: DataFrame, sequence_limit: int, mode: PriceMode = EXACT) -> DataFrame:
    """Messages that make no candle only because of the limit, as they are, with the reason.

    The others that make none are no matter of the limit: the gate and ``ingest.grade`` tell them.
    """
    ticks = parse_json_once(
        log.select("offset", "value"), F.col("value").cast("string"), MESSAGE, "offset", "value"
    )
    graded = grade(
        ticks.withColumn("sequence", F.coalesce("sequence", "offset")), mode, sequence_limit
    )
    return (
        quarantined(graded)
        .filter(F.col("reason") == BAD_SEQUENCE)
        .select("offset", "value", "sequence", "pair", "timestamp", "reason")
    )


def mids_from_messages(log: DataFrame, mode: PriceMode = EXACT) -> DataFrame:
    """Log rows to ``(pair, timestamp, sequence, mid_price)``."""
    return with_mid(decode_messages(log, mode), mode)


def with_mid(ticks: DataFrame, mode: PriceMode = EXACT) -> DataFrame:
    """Typed ticks to mid prices."""
    return ticks.select(
        "pair",
        "timestamp",
        "sequence",
        mid_price(F.col("bid"), F.col("ask"), mode).alias("mid_price"),
    )


def mids_from_quotes(quotes: DataFrame, mode: PriceMode = EXACT) -> DataFrame:
    """Text-priced quotes straight to mid prices, without a round trip through the log.

    A tick the quality gate rejects has no decimal price, so its mid is NULL and candles skip it.
    """
    typed = quotes.select(
        "pair",
        "timestamp",
        "sequence",
        parse_price(F.col("bid"), mode).alias("bid"),
        parse_price(F.col("ask"), mode).alias("ask"),
    )
    return with_mid(typed, mode)
