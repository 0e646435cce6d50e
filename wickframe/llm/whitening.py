"""Operator 11: whitening of embeddings by a bidiagonal qd solver.

1. Each usable vector becomes whole numbers; the distinct ones are the fit list, a table in the shared folder.
2. Count and sums per dimension, exact, by a grouping of one row for each task and dimension.
3. Tasks reduce their centred rows block by block to triangles (QR); triangles are reduced together in rounds
   of a bounded number of them until one is left. It is as large as the dimension, whatever the table.
4. The driver turns that triangle into a bidiagonal by Householder mirrors, takes its singular values by dqds
   and the directions by twisted factorisations (:mod:`wickframe.llm.bidiagonal`).
5. One more pass over the fit list gives the covariance of what is whitened, one over all rows the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.bidiagonal import right_singular
from wickframe.llm.runtime import Batches, map_batches, written
from wickframe.llm.vectors import packed, unpacked, usual_dimension, vector_rows, whole_numbers

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
# Whole numbers beyond this are not exact in a double any more.
LIMIT = 1 << 52
# Numbers of all triangles that one task reduces together.
TOGETHER = 1 << 22

RESULT = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: count and exact sums of the fit list, directions, shares of the variance."""

    dimension: int
    scale: int
    offset: int
    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # a column for each component, divided by its standard deviation
    explained: np.ndarray
    identity_error: float

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        """``n * x - S`` for rows of whole numbers, exact; Python's whole numbers where 64 bits are too few."""
        near = np.array([total // self.n for total in self.sums], object)  # cancels the offset
        rest = np.array([total - self.n * int(middle) for total, middle in zip(self.sums, near)], object)
        widest = int(np.abs(numbers).max(initial=0)) + int(np.abs(near).max(initial=0)) + 1
        kind = np.int64 if self.n * widest < 1 << 62 else object
        return self.n * (numbers.astype(kind) - near.astype(kind)) - rest.astype(kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.directions

    def deviations(self, centred: np.ndarray) -> pa.Array:
        """Sums of squares, exact; null where a sum does not fit in a BIGINT."""
        if centred.dtype == object or int(np.abs(centred).max(initial=0)) ** 2 * self.dimension >= 1 << 63:
            sums = [sum(int(entry) ** 2 for entry in row) for row in centred]
            return pa.array([total if total < 1 << 63 else None for total in sums], pa.int64())
        return pa.array((centred * centred).sum(axis=1), pa.int64())


def _fit_list(rows: DataFrame, dimension: int, scale: int) -> DataFrame:
    """``(packed)``: each distinct vector of whole numbers once; copies meet on the map side first."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            _, numbers = whole_numbers(batch, dimension, scale, LIMIT)
            yield pa.RecordBatch.from_arrays([packed(numbers)], ["packed"])

    return map_batches(rows.select("id", "vector"), run, "packed binary").distinct()


def _moments(fit: DataFrame, dimension: int, offset: int) -> tuple[int, tuple[int, ...]]:
    """Count and sums of the fit list: a row for each task and dimension is all that is shuffled."""

    def run(batches: Batches) -> Batches:
        count, sums = 0, np.zeros(dimension, object)
        for batch in batches:
            numbers = unpacked(batch.column("packed"), dimension)
            count += len(numbers)
            # Halves of the numbers, so that no sum over a batch can overflow.
            high, low = numbers >> 26, numbers & ((1 << 26) - 1)
            sums += high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)
        if count:
            totals = [str(int(total) + count * offset) for total in sums] + [str(count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimension + 1), pa.int32()), pa.array(totals)], ["place", "total"]
            )

    parts = map_batches(fit, run, "place int, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals = {row["place"]: int(row["total"]) for row in rows}
    return totals.get(dimension, 0), tuple(totals.get(place, 0) for place in range(dimension))


def _triangle(upper: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([upper, rows]), mode="r")


def _reduced(fit: DataFrame, centre: Whitening) -> np.ndarray:
    """The triangle of the centred fit list's QR."""
    dimension = centre.dimension

    def as_row(part: int, upper: np.ndarray) -> pa.RecordBatch:
        whole = np.zeros((dimension, dimension))
        whole[: len(upper)] = upper
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([whole.tobytes()], pa.binary())], ["part", "triangle"])

    def run(batches: Batches) -> Batches:
        upper = np.zeros((0, dimension))
        for batch in batches:
            numbers = unpacked(batch.column("packed"), dimension) + centre.offset
            for start in range(0, len(numbers), 4096):
                block = (centre.centred(numbers[start : start + 4096]) / centre.n).astype(np.float64)
                upper = _triangle(upper, block)
        if len(upper):
            yield as_row(TaskContext.get().partitionId(), upper)

    def together(batches: Batches) -> Batches:
        upper, part = np.zeros((0, dimension)), 0
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.column("part")[at].as_py()
                upper = _triangle(upper, np.frombuffer(batch.column("triangle")[at].as_py()).reshape(dimension, dimension))
        if len(upper):
            yield as_row(part, upper)

    parts = written(map_batches(fit, run, "part bigint, triangle binary"), "whitening-triangles")
    few = max(2, min(64, TOGETHER // dimension**2))
    while (left := parts.count()) > 1:
        groups = -(-left // few)
        dealt = parts.withColumn("part", F.col("part") % groups).repartition(groups, "part")
        parts = written(map_batches(dealt, together, "part bigint, triangle binary"), "whitening-triangles")
    return np.frombuffer(parts.first()["triangle"]).reshape(dimension, dimension)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    components = model.directions.shape[1]

    def run(batches: Batches) -> Batches:
        count, sums, products = 0, np.zeros(components), np.zeros((components, components))
        for batch in batches:
            numbers = unpacked(batch.column("packed"), model.dimension) + model.offset
            whitened = model.whitened(model.centred(numbers))
            count += len(whitened)
            sums += whitened.sum(axis=0)
            products += whitened.T @ whitened
        if count:
            totals = np.concatenate([sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals)], ["place", "total"])

    parts = map_batches(fit, run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    totals = np.zeros(components + components**2)
    for row in parts.collect():
        totals[row["place"]] = row["total"]
    mean = totals[:components] / model.n
    covariance = totals[components:].reshape(components, components) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(components)).max(initial=0.0))


def fit(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    dimension: int | None = None,
) -> Whitening:
    """The whitening of a table's distinct vectors ``x = floor(scale * entry) + offset``.

    Vectors of ``dimension`` entries count, by default the length most vectors have. Null vectors and those
    with null, infinite or NaN entries are left out, so are entries of ``LIMIT / scale`` or more. Repeated
    vectors count once. Directions without any variance cannot be whitened: the model has as many components
    as the fit list has directions that vary, up to ``components``; none for an empty table or one distinct vector.
    """
    rows = vector_rows(df, id_col, vector_col)
    dimension = usual_dimension(rows) if dimension is None else dimension
    empty = Whitening(dimension, scale, offset, 0, (0,) * dimension, np.zeros((dimension, 0)), np.zeros(0), 0.0)
    if not dimension:
        return empty
    distinct = written(_fit_list(rows, dimension, scale), "whitening-fit")
    n, sums = _moments(distinct, dimension, offset)
    centre = Whitening(dimension, scale, offset, n, sums, empty.directions, empty.explained, 0.0)
    if n < 2:
        return centre
    squares, directions = right_singular(_reduced(distinct, centre))
    kept = min(components, int((squares > 0).sum()))
    scaled = directions[:, :kept] / np.sqrt(squares[:kept] / n)
    explained = squares[:kept] / squares.sum()
    model = Whitening(dimension, scale, offset, n, sums, scaled, explained, 0.0)
    return Whitening(dimension, scale, offset, n, sums, scaled, explained, _identity_error(distinct, model))


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: ``(id, component, n, deviation, whitened, explained, identity_error)``.

    ``deviation`` is the sum of ``(n * x - S)**2`` over the dimensions, null where it does not fit in a BIGINT.
    Rows that :func:`fit` leaves out, or of another length than the model's, have no row; repeated rows have
    theirs each, null ids stay null, other columns of ``df`` play no part.
    """
    components = model.directions.shape[1]
    if not components:
        empty = df.sparkSession.createDataFrame([], RESULT)
        return empty.select(F.col("id").alias(id_col), *empty.columns[1:])
    shared = df.sparkSession.sparkContext.broadcast(model)  # dimension times components numbers

    def run(batches: Batches) -> Batches:
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                ids, numbers = whole_numbers(whole.slice(start, 4096), model.dimension, model.scale, LIMIT)
                centred = model.centred(numbers + model.offset)
                each = np.repeat(np.arange(len(ids)), components)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, components + 1, dtype=np.int32), len(ids))),
                        pa.array(np.full(len(each), model.n, np.int64)),
                        model.deviations(centred).take(pa.array(each)),
                        pa.array(model.whitened(centred).ravel()),
                        pa.array(np.tile(model.explained, len(ids))),
                        pa.array(np.full(len(each), model.identity_error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    found = map_batches(vector_rows(df, id_col, vector_col), run, RESULT)
    return found.select(F.col("id").alias(id_col), *found.columns[1:])
