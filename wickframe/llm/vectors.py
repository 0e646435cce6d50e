"""Vectors of a table as whole numbers: scaled, rounded down, packed into short byte strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)`` with ids as BIGINT and vectors as doubles, whatever else the table has."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )


def whole_numbers(batch: pa.RecordBatch, dimension: int, scale: int, limit: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and ``floor(scale * entry)`` of the vectors that have ``dimension`` entries, all of them usable.

    Null vectors, other lengths, null, infinite and NaN entries are passed over, and so are vectors with an
    entry whose whole number is ``limit`` or more, or below ``-limit``: sums over them would not be exact.
    """
    fits = pc.equal(pc.list_value_length(batch.column("vector")), dimension)
    batch = batch.filter(fits)  # a null length is no match
    entries = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    with np.errstate(over="ignore", invalid="ignore"):
        entries = np.floor(entries * scale)
    usable = (np.abs(entries) < limit).all(axis=1)  # NaN and infinity are not
    return batch.column("id").filter(pa.array(usable)), entries[usable].astype(np.int64)


def packed(numbers: np.ndarray) -> pa.Array:
    """Each row in the narrowest of two, four or eight bytes a number that hold it: equal rows, equal bytes."""
    out = np.empty(len(numbers), object)
    size = np.abs(numbers).max(axis=1, initial=0)
    for width, low, high in ((2, -1, 1 << 15), (4, (1 << 15) - 1, 1 << 31), (8, (1 << 31) - 1, None)):
        rows = (size > low) if high is None else (size > low) & (size < high)
        narrow = np.ascontiguousarray(numbers[rows].astype(f"<i{width}"))
        if len(narrow):
            out[rows] = narrow.view(f"V{narrow.shape[1] * width}").ravel().tolist()
    return pa.array(out, pa.binary())


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    """The numbers that :func:`packed` made bytes of."""
    rows = column.to_pylist()
    widths = np.array([len(row) // dimension for row in rows], np.int64)
    numbers = np.empty((len(rows), dimension), np.int64)
    for width in (2, 4, 8):
        at = np.nonzero(widths == width)[0]
        if len(at):
            joined = b"".join([rows[i] for i in at])
            numbers[at] = np.frombuffer(joined, f"<i{width}").reshape(-1, dimension)
    return numbers


def usual_dimension(rows: DataFrame) -> int:
    """The length that most vectors have, of equally frequent ones the largest; 0 where there is none."""
    lengths = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return most[0]["length"] if most else 0
