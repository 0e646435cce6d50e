"""The candle table's contract: no NULL in any column, one row per pair and open time."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.schemas import CANDLE_COLUMNS, CANDLE_KEY


def breaks_not_null(columns: Iterable[str] = CANDLE_COLUMNS) -> Column:
    """Whether a row has a NULL where the table allows none."""
    return reduce(or_, (F.col(c).isNull() for c in columns))


def not_null_violations(candle_rows: DataFrame) -> DataFrame:
    """One row with the number of candles the table would refuse."""
    return candle_rows.agg(F.count_if(breaks_not_null()).alias("violations"))


def unique_violations(candle_rows: DataFrame) -> DataFrame:
    """One row with the number of keys that occur more than once."""
    per_key = candle_rows.groupBy(*CANDLE_KEY).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("violations"))
