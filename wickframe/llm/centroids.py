"""Operator 12: k-means over whole numbers, with a heap of bounds for each cluster.

The vectors lie in blocks, one row of a table for each Arrow batch, with their clusters and one heap for each
cluster. A heap orders vectors by their gap, the distance to the second nearest centroid less that to the
nearest, plus what the cluster's bounds had drifted when the gap was measured. A round moves the centroids,
adds to each cluster's drift what its own and the fastest other centroid moved, and pops the vectors whose gap
the drift has used up. Only those are measured again, exactly; the others cannot have changed cluster.

Each round reads the blocks and writes them anew, without a shuffle; beside them lie the changes of the
cluster's sums, which are added up in Spark and leave one row for each cluster and dimension. What was
read is removed when what was written is whole. Centroids are the only thing on the driver.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.llm.runtime import Batches, map_batches
from wickframe.llm.vectors import vector_rows, whole_numbers
from wickframe.session import scoped_conf, scratch_dir
from wickframe.streaming import paths

CLUSTERS = 40
ROUNDS = 5
DIMENSION = 64
SCALE = 256
# Squared distances between such numbers fit in a BIGINT for 64 dimensions and more.
LIMIT = 1 << 27
# Up to here products of numbers add up exactly in doubles.
EXACT = 1 << 20
# Vectors in a block, blocks read at once, blocks in an Arrow batch: rows are large.
BLOCK = 4096
_LARGE_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "16", "spark.sql.execution.arrow.maxRecordsPerBatch": "4"}
# Gaps are doubles; what is nearer to used up than this, in parts of the distances, is measured again.
SLACK = 1e-9

_BLOCKS = "ids binary, vectors binary, clusters binary, order binary, keys binary, changes binary, measured bigint"


@dataclass(frozen=True)
class Clustering:
    """``assigned`` has ``(id, cluster, distance)`` for each vector, distances squared."""

    assigned: DataFrame
    centroids: np.ndarray
    inertias: dict[int, int]  # distances summed by cluster
    measured: tuple[int, ...]  # vectors measured in each round


def _squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """All squared distances of vectors to centroids, exact."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if largest < EXACT and vectors.shape[1] <= 1 << 12 else np.int64
    v, c = vectors.astype(kind), centroids.astype(kind)
    squares = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)[None, :]
    return squares.astype(np.int64)


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, of equal ones the first, and how much farther the second is."""
    squares = _squared(vectors, centroids)
    nearest = squares.argmin(axis=1)
    if len(centroids) == 1:
        return nearest, np.full(len(vectors), np.inf)
    rows = np.arange(len(vectors))
    first = np.sqrt(squares[rows, nearest].astype(np.float64))
    squares[rows, nearest] = np.iinfo(np.int64).max
    second = np.sqrt(squares.min(axis=1).astype(np.float64))
    return nearest, (second - first) - SLACK * (second + first)


class Heaps:
    """A heap of ``(gap + drift at its measuring, place in the block)`` for each cluster."""

    def __init__(self, clusters: int, order: np.ndarray | None = None, keys: np.ndarray | None = None, owners: np.ndarray | None = None):
        self._heaps: list[list[tuple[float, int]]] = [[] for _ in range(clusters)]
        if order is not None and len(order):
            ends = np.nonzero(np.diff(owners[order]))[0] + 1  # heaps lie one after another
            for places, some in zip(np.split(order, ends), np.split(keys, ends)):
                self._heaps[owners[places[0]]] = list(zip(some.tolist(), places.tolist()))

    def expired(self, drift: np.ndarray) -> list[int]:
        """Pop all whose gap the drift of their cluster has used up."""
        out = []
        for heap, limit in zip(self._heaps, drift.tolist()):
            while heap and heap[0][0] <= limit:
                out.append(heapq.heappop(heap)[1])
        return out

    def put(self, places: np.ndarray, clusters: np.ndarray, gaps: np.ndarray, drift: np.ndarray) -> None:
        for place, cluster, key in zip(places.tolist(), clusters.tolist(), (gaps + drift[clusters]).tolist()):
            heapq.heappush(self._heaps[cluster], (key, place))

    def stored(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys, heap after heap, each in its heap's order."""
        flat = [item for heap in self._heaps for item in heap]
        return np.array([place for _, place in flat], np.int32), np.array([key for key, _ in flat], np.float64)


def _changes(vectors: np.ndarray, clusters: np.ndarray, sign: int, into: np.ndarray) -> None:
    """Add count and sums of the vectors to the rows of their clusters."""
    order = np.argsort(clusters, kind="stable")
    starts = np.nonzero(np.diff(clusters[order], prepend=-1))[0]
    if len(starts):
        sums = np.add.reduceat(vectors[order], starts, axis=0)
        counts = np.diff(np.append(starts, len(order)))
        into[clusters[order][starts]] += sign * np.column_stack([counts, sums])


def _block(ids: bytes, vectors: bytes, clusters: np.ndarray, heaps: Heaps, changes: np.ndarray, measured: int) -> pa.RecordBatch:
    order, keys = heaps.stored()
    values = [ids, vectors, clusters.astype(np.int32).tobytes(), order.tobytes(), keys.tobytes(), changes.tobytes()]
    arrays = [pa.array([value], pa.binary()) for value in values] + [pa.array([measured], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["ids", "vectors", "clusters", "order", "keys", "changes", "measured"])


def _kept(ids: pa.Array, vectors: np.ndarray) -> tuple[bytes, bytes]:
    """Ids with marks of nulls, and vectors in the narrowest width that holds them, as bytes."""
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    width = next(w for w in (2, 4, 8) if np.abs(vectors).max(initial=0) < 1 << (8 * w - 1))
    return ids.fill_null(0).to_numpy().astype("<i8").tobytes() + nulls.tobytes(), vectors.astype(f"<i{width}").tobytes()


def _restored(ids: bytes, vectors: bytes, dimension: int) -> tuple[pa.Array, np.ndarray]:
    count = len(ids) // 9
    width = len(vectors) // (count * dimension)
    numbers = np.frombuffer(vectors, f"<i{width}").reshape(count, dimension).astype(np.int64)
    return pa.array(np.frombuffer(ids, "<i8", count), mask=np.frombuffer(ids, bool, count, 8 * count)), numbers


def first_centroids(rows: DataFrame, clusters: int, dimension: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; null ids come last."""
    fits = f"x is not null and x * {scale} < {LIMIT} and x * {scale} > {-LIMIT + 1}"
    usable = f"size(vector) = {dimension} and forall(vector, x -> {fits})"
    drawn = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    chosen = (
        rows.where(usable)
        .select(drawn.alias("drawn"), F.transform("vector", lambda x: F.floor(x * scale)).alias("numbers"))
        .orderBy(F.asc_nulls_last("drawn"), "numbers")
        .limit(clusters)
        .collect()
    )
    return np.array([row["numbers"] for row in chosen], np.int64).reshape(-1, dimension)


def _started(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """Blocks of all usable vectors, each measured and in the heap of its cluster."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    clusters, dimension = centroids.shape

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                ids, vectors = whole_numbers(batch.slice(start, BLOCK), dimension, scale, LIMIT)
                if not len(ids):
                    continue
                nearest, gaps = _nearest(vectors, shared.value)
                heaps = Heaps(clusters)
                heaps.put(np.arange(len(ids)), nearest, gaps, np.zeros(clusters))
                changes = np.zeros((clusters, dimension + 1), np.int64)
                _changes(vectors, nearest, 1, changes)
                yield _block(*_kept(ids, vectors), nearest, heaps, changes, len(ids))

    return map_batches(rows, run, _BLOCKS)


def _moved(blocks: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """Blocks after a round: vectors whose gap is used up are measured and change heaps, the rest stays."""
    shared = blocks.sparkSession.sparkContext.broadcast((centroids, drift))
    clusters, dimension = centroids.shape

    def run(batches: Batches) -> Batches:
        centroids, drift = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                owners = np.frombuffer(row["clusters"], np.int32).copy()
                heaps = Heaps(clusters, np.frombuffer(row["order"], np.int32), np.frombuffer(row["keys"]), owners)
                places = np.array(heaps.expired(drift), np.int64)
                changes = np.zeros((clusters, dimension + 1), np.int64)
                if len(places):
                    vectors = _restored(row["ids"], row["vectors"], dimension)[1][places]
                    nearest, gaps = _nearest(vectors, centroids)
                    heaps.put(places, nearest, gaps, drift)
                    left = owners[places] != nearest
                    _changes(vectors[left], owners[places[left]], -1, changes)
                    _changes(vectors[left], nearest[left], 1, changes)
                    owners[places] = nearest
                yield _block(row["ids"], row["vectors"], owners, heaps, changes, len(places))

    return map_batches(blocks, run, _BLOCKS)


def _sums_of_changes(blocks: DataFrame, clusters: int, dimension: int) -> np.ndarray:
    """What count and sums of each cluster have changed by; a row for each task and number is shuffled."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(clusters * (dimension + 1), np.int64)
        for batch in batches:
            for changes in batch.column("changes").to_pylist():
                total += np.frombuffer(changes, np.int64)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["place", "total"])

    parts = map_batches(blocks.select("changes"), run, "place int, total bigint")
    out = np.zeros(clusters * (dimension + 1), object)
    for row in parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[row["place"]] = int(row["total"])
    return out.reshape(clusters, dimension + 1)


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                ids, vectors = _restored(row["ids"], row["vectors"], shared.value.shape[1])
                owners = np.frombuffer(row["clusters"], np.int32)
                apart = vectors - shared.value[owners]
                arrays = [ids, pa.array(owners), pa.array((apart * apart).sum(axis=1))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "cluster", "distance"])

    return map_batches(blocks.select("ids", "vectors", "clusters"), run, "id bigint, cluster int, distance bigint")


def _stored(spark: SparkSession, df: DataFrame, label: str) -> tuple[str, DataFrame]:
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
) -> Clustering:
    """Cluster all vectors of ``dimension`` entries, as whole numbers ``floor(scale * entry)``.

    Centroids start as the vectors whose ids have the smallest SHA-256 of ``2:<id>``, of rows with one id the
    smaller vector first, null ids last; fewer vectors than ``clusters`` make that many centroids. ``rounds``
    times all vectors go to the nearest centroid, of equally near ones the first, and centroids become the mean
    rounded down; one without vectors stays. Vectors go to the nearest once more then.

    Null vectors, other lengths, null, infinite and NaN entries are left out, and so are vectors with an entry
    of ``LIMIT / scale`` (2^19) or more, whose distances do not fit in a BIGINT. Repeated rows count each; an
    empty table has no centroids and no rows. Other columns of ``df`` play no part.
    """
    spark = df.sparkSession
    rows = vector_rows(df, id_col, vector_col)
    centroids = first_centroids(rows, clusters, dimension, scale)
    if not len(centroids):
        return Clustering(spark.createDataFrame([], "id bigint, cluster int, distance bigint"), centroids, {}, ())
    count = len(centroids)
    drift = np.zeros(count)
    totals = np.zeros((count, dimension + 1), object)
    measured = []
    with scoped_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BLOCK)}):
        path, blocks = _stored(spark, _started(rows, centroids, scale), "centroid-blocks")
    with scoped_conf(spark, _LARGE_ROWS):
        for _ in range(rounds):
            totals += _sums_of_changes(blocks, count, dimension)
            means = [[total // row[0] for total in row[1:]] if row[0] else old for row, old in zip(totals, centroids.tolist())]
            moved, centroids = centroids, np.array(means, np.int64)
            lengths = np.array([math.sqrt(sum(x * x for x in row)) for row in (centroids - moved).tolist()])
            others = np.full(count, lengths.max())
            if count > 1:
                others[lengths.argmax()] = np.delete(lengths, lengths.argmax()).max()
            drift = drift + lengths + others
            measured.append(blocks.agg(F.sum("measured")).first()[0])
            before = path
            path, blocks = _stored(spark, _moved(blocks, centroids, drift), "centroid-blocks")
            paths.delete(spark, before)
        measured.append(blocks.agg(F.sum("measured")).first()[0])
        _, assigned = _stored(spark, _assigned(blocks, centroids), "centroid-assigned")
        paths.delete(spark, path)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    return Clustering(assigned, centroids, {row["cluster"]: int(row["total"]) for row in sums}, tuple(measured))


def digests(found: Clustering, id_col: str = "vec_id") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` for each vector."""
    spark = found.assigned.sparkSession
    whole = sum(found.inertias.values())
    named = [
        (at, total, whole, hashlib.sha256(",".join(map(str, found.centroids[at].tolist())).encode()).hexdigest())
        for at, total in sorted(found.inertias.items())
    ]
    of_cluster = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = found.assigned.join(F.broadcast(of_cluster), "cluster")  # one row for each cluster
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
