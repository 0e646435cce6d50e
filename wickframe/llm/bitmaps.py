"""Sets of small numbers as bitmaps, built by Spark and broadcast with a size fixed beforehand."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_bits(numbers: DataFrame, column: str, bits: int) -> Broadcast:
    """The numbers in ``column``, from 0 to ``bits - 1``, as a bitmap of ``bits`` bits for :func:`holds`.

    Spark builds it in pieces of 4 KB; what comes to the driver and goes out is ``bits / 8`` bytes at
    most, whatever the number of rows.
    """
    number = F.col(column) + 1
    pieces = (
        numbers.groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
        .collect()
    )
    whole = np.zeros(-(-bits // 8), np.uint8)
    for row in pieces:
        piece = np.frombuffer(row["bitmap"], np.uint8)
        start = (row["bucket"] - 1) * len(piece)
        whole[start : start + len(piece)] = piece[: len(whole) - start]
    return numbers.sparkSession.sparkContext.broadcast(whole)


def holds(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which of the numbers are in the bitmap."""
    return (bitmap[numbers >> 3] >> (numbers & 7).astype(np.uint8) & 1).astype(bool)
