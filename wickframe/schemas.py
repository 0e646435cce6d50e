"""Declared schemas and price modes. Nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw quote as the exchange sends it: update id, symbol, bid price/qty, ask price/qty.
# Prices and quantities are strings on the wire.
RAW_QUOTE = T.StructType(
    [
        T.StructField("u", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.StringType()),
        T.StructField("B", T.StringType()),
        T.StructField("a", T.StringType()),
        T.StructField("A", T.StringType()),
    ]
)

# The columns of the events table that stand in for a quote feed.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# One row of the keyed message log, whatever stores it (Kafka topic or files of that shape).
LOG_ROW = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

# The value of a log message. Prices are text; the sequence may be absent.
MESSAGE = T.StructType(
    [
        T.StructField("bid", T.StringType()),
        T.StructField("ask", T.StringType()),
        T.StructField("pair", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("sequence", T.LongType()),
    ]
)

# Candle columns in table order; all of them are NOT NULL by contract.
CANDLE_COLUMNS = (
    "currency_pair",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "open_time",
    "close_time",
)
CANDLE_KEY = ("currency_pair", "open_time")
CANDLE_PRICES = ("open_price", "high_price", "low_price", "close_price")


@dataclass(frozen=True)
class PriceMode:
    """How price text becomes a number, and what type the mid price has."""

    name: str
    precision: int
    scale: int
    mid_is_double: bool

    @property
    def price_type(self) -> T.DecimalType:
        return T.DecimalType(self.precision, self.scale)

    @property
    def mid_type(self) -> T.DataType:
        return T.DoubleType() if self.mid_is_double else self.price_type


# Default: prices keep 8 decimals, the mid is a decimal too.
EXACT = PriceMode("exact", 20, 8, mid_is_double=False)
# Prices rounded half-up to whole units before the mid, which is a double.
COMPAT = PriceMode("compat", 10, 0, mid_is_double=True)


def tick_schema(mode: PriceMode) -> T.StructType:
    """Schema of a decoded tick message."""
    return T.StructType(
        [
            T.StructField("bid", mode.price_type),
            T.StructField("ask", mode.price_type),
            T.StructField("pair", T.StringType()),
            T.StructField("timestamp", T.TimestampNTZType()),
        ]
    )


def candle_schema(mode: PriceMode = EXACT) -> T.StructType:
    """Schema of a candle row."""
    price = mode.mid_type
    return T.StructType(
        [T.StructField("currency_pair", T.StringType(), False)]
        + [T.StructField(c, price, False) for c in CANDLE_PRICES]
        + [T.StructField(c, T.TimestampNTZType(), False) for c in ("open_time", "close_time")]
    )


def pane_schema(mode: PriceMode = EXACT) -> T.StructType:
    """Schema of a stored pane: its prices and the order keys of the first and last tick."""
    price, rank = mode.mid_type, T.DecimalType(38, 0)
    return T.StructType(
        [
            T.StructField("pair", T.StringType(), False),
            T.StructField("pane_start", T.TimestampNTZType(), False),
            T.StructField("open_price", price, False),
            T.StructField("open_rank", rank, False),
            T.StructField("high_price", price, False),
            T.StructField("low_price", price, False),
            T.StructField("close_price", price, False),
            T.StructField("close_rank", rank, False),
        ]
    )


def ranked_schema(mode: PriceMode = EXACT) -> T.StructType:
    """Schema of a candle with the order keys of its first and last tick."""
    ranks = [T.StructField(c, T.DecimalType(38, 0), False) for c in ("open_rank", "close_rank")]
    return T.StructType([*candle_schema(mode), *ranks])
