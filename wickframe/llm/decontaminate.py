"""Operator 10: documents that hold benchmark items, by SimHash windows of the items' sizes.

Items and texts are sequences of lower-cased words without punctuation, compared as multisets of
five-word shingles; an item of fewer words is one shingle, the whole of it. A text is read in windows as long as an
item; the weighted similarity of a window and an item is the sum of the lower counts of each shingle over the sum of
the higher ones. Windows of 0.8 and more are leaks.

Windows that share no shingle with any item have similarity 0, and no fingerprint is made of them. The
others get a SimHash of 256 bits, kept current by sums as the window slides. Fingerprints within ``RADIUS`` bits of an
item's lie within a ``BLOCKS``-th of that in at least one of ``BLOCKS`` blocks of 64 bits. So the items of a size whose
block comes that close in some block are all there can be; of unrelated items one in 2,000 does. Those are
compared on all bits, and what is left shingle by shingle. At similarity 0.8 fingerprints differ in 39 bits on
average, give or take 6; with 68 fewer than one such pair in 100,000 is lost, and none of equal text.

The benchmark is a query set: it is cut into blocks of a bounded number of words, and every document
meets every block in the task that reads it. One block at a time is on the driver and in the tasks. Nothing of the
documents is shuffled but the numbers of those that hold an item, where there are several blocks.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.llm.runtime import Batches, kept, map_batches, slices, written

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 4
RADIUS = 68

# Words of benchmark items that one broadcast may hold.
BLOCK_WORDS = 2_000_000
# Windows and items that are compared at once, and windows whose sums are: they bound memory for texts of any length.
_TABLE = 1 << 18
_STARTS = 1024

_words = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _words.findall((text or "").lower())


def shingles(words: list[str]) -> Counter:
    return Counter(tuple(words[at : at + SHINGLE]) for at in range(len(words) - SHINGLE + 1))


def similarity(left: Counter, right: Counter) -> float:
    """Weighted similarity of two shingle multisets; 0 where both are empty."""
    lower = sum(min(n, right[key]) for key, n in left.items() if key in right)
    higher = left.total() + right.total() - lower
    return lower / higher if higher else 0.0


def _signs(words: list[str], start: int, end: int) -> np.ndarray:
    """Rows of +1 and -1, one for each bit of each shingle that starts in ``[start, end)``."""
    if end <= start:
        return np.zeros((0, 64 * BLOCKS), np.int32)
    texts = [" ".join(words[at : at + SHINGLE]) for at in range(start, end)]
    hashes = np.array([[xxhash.xxh3_64_intdigest(text, block) for block in range(BLOCKS)] for text in texts], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(len(texts), -1), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """A row of blocks for each row of sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8")


def near_blocks(prints: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a window and an item that come close in some block: no other pair is within the radius."""
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    step = max(1, _TABLE // max(1, len(prints)))
    for at in range(0, len(windows), step):
        some = windows[at : at + step]
        close = np.zeros((len(some), len(prints)), bool)
        for block in range(BLOCKS):
            close |= np.bitwise_count(some[:, None, block] ^ prints[None, :, block]) <= RADIUS // BLOCKS
        window, item = np.nonzero(close)
        found.append((window + at, item))
    windows_of, items_of = zip(*found)
    return np.concatenate(windows_of), np.concatenate(items_of)


class Benchmark:
    """Index of one block of items: their words, shingles and fingerprints by size."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]]):
        self.ids: list[int | None] = []
        self.words: list[list[str]] = []
        self._vocabulary: dict[str, int] = {}
        self._short: dict[int, dict[tuple[str, ...], list[int]]] = defaultdict(dict)
        sizes_of: dict[int, set[int]] = defaultdict(set)
        of_size: dict[int, list[int]] = defaultdict(list)
        prints: dict[int, list[np.ndarray]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            place, size = len(self.ids), len(words)
            self.ids.append(item_id)
            self.words.append(words)
            if size < SHINGLE:
                self._short[size].setdefault(tuple(words), []).append(place)
                continue
            of_size[size].append(place)
            sums = sum(part.sum(axis=0) for part in _in_parts(words, 0, size - SHINGLE + 1))
            prints[size].append(_fingerprints(sums[None])[0])
            for word in words:
                self._vocabulary.setdefault(word, len(self._vocabulary))
            for key in set(self._keys(words).tolist()):
                sizes_of[key].add(size)
        self._known = np.array(sorted(sizes_of), np.uint64)
        self._sizes_of = sizes_of
        self._of_size = {size: np.array(places) for size, places in of_size.items()}
        self._prints = {size: np.stack(rows) for size, rows in prints.items()}
        self._counts: dict[int, Counter] = {}

    def _count(self, item: int) -> Counter:
        """An item's shingles, kept once they were needed."""
        if item not in self._counts:
            self._counts[item] = shingles(self.words[item])
        return self._counts[item]

    def _keys(self, words: list[str]) -> np.ndarray:
        """A number for each shingle, 0 where one of its words is in no item."""
        places = np.fromiter((self._vocabulary.get(w, -1) for w in words), np.int64, len(words))
        count = len(words) - SHINGLE + 1
        keys, known = np.zeros(count, np.uint64), np.ones(count, bool)
        for at in range(SHINGLE):
            part = places[at : at + count]
            known &= part >= 0
            keys = (keys + part.astype(np.uint64) + np.uint64(1)) * _STEP
        return np.where(known, keys, np.uint64(0))

    def leaks(self, text: str | None) -> dict[int, float]:
        """Items the text holds, by their place in ``ids``, with the highest similarity of a window."""
        words = words_of(text)
        found: dict[int, float] = {}
        for size, known in self._short.items():
            for at in range(len(words) - size + 1):
                for item in known.get(tuple(words[at : at + size]), ()):
                    found[item] = 1.0
        if len(words) < SHINGLE or not len(self._known):
            return found
        keys = self._keys(words)
        places = np.minimum(np.searchsorted(self._known, keys), len(self._known) - 1)
        hits = np.nonzero((self._known[places] == keys) & (keys != 0))[0]
        if not len(hits):
            return found
        hits_of: dict[int, list[int]] = defaultdict(list)
        for hit in hits.tolist():
            for size in self._sizes_of[int(keys[hit])]:
                hits_of[size].append(hit)
        for size, at in hits_of.items():
            self._windows(words, size, np.array(at), found)
        return found

    def _windows(self, words: list[str], size: int, hits: np.ndarray, found: dict[int, float]) -> None:
        """Compare all windows of one size that hold a hit, some at a time; a shorter text is one window."""
        width = min(size, len(words))
        span = width - SHINGLE + 1
        last = len(words) - width
        for first, end in _runs(hits, span, last):
            sums, base = None, first
            for start in range(first, end, _STARTS):
                stop = min(start + _STARTS, end)
                # Sums of the first window of a part, then what each step takes away and adds.
                if sums is None:
                    sums = sum(part.sum(axis=0) for part in _in_parts(words, base, base + span))
                steps = _signs(words, start + span, stop - 1 + span) - _signs(words, start, stop - 1)
                all_sums = np.vstack([sums[None], sums + np.cumsum(steps, axis=0)]) if len(steps) else sums[None]
                self._compare(words, width, size, start, _fingerprints(all_sums), found)
                if stop < end:
                    sums = all_sums[-1] + _signs(words, stop - 1 + span, stop + span)[0] - _signs(words, stop - 1, stop)[0]

    def _compare(self, words: list[str], width: int, size: int, first: int, windows: np.ndarray, found: dict[int, float]) -> None:
        prints, items = self._prints[size], self._of_size[size]
        window, place = near_blocks(prints, windows)
        near = np.bitwise_count(windows[window] ^ prints[place]).sum(axis=1, dtype=np.int64) <= RADIUS
        counted: tuple[int, Counter] = (-1, Counter())
        for at, item in zip(window[near].tolist(), items[place[near]].tolist()):
            if found.get(item, 0) < 1:
                if counted[0] != at:
                    counted = at, shingles(words[first + at : first + at + width])
                same = similarity(counted[1], self._count(item))
                if same >= SIMILARITY:
                    found[item] = max(same, found.get(item, 0.0))


def _in_parts(words: list[str], start: int, end: int) -> Iterator[np.ndarray]:
    """Signs of the shingles that start in ``[start, end)``, some at a time."""
    for at in range(start, end, _STARTS):
        yield _signs(words, at, min(at + _STARTS, end))


def _runs(hits: np.ndarray, span: int, last: int) -> list[tuple[int, int]]:
    """Ranges of starts whose windows hold a hit; ``hits`` rise."""
    out: list[tuple[int, int]] = []
    for hit in hits.tolist():
        first, end = min(max(hit - span + 1, 0), last), min(hit, last) + 1
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((first, end))
    return out


def _benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> tuple[int, Iterator[list]]:
    """How many blocks of about ``block_words`` words there are, and their items, a block at a time."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    place = F.abs(F.xxhash64("id", "text") % blocks)

    def read() -> Iterator[list]:
        for at in range(blocks):
            some = {tuple(row) for row in items.where(place == at).collect()}
            yield sorted(some, key=lambda row: (row[0] is None, *map(str, row)))

    return blocks, read()


_FOUND = "n_items bigint, item_ids array<bigint>, similarity double"


def _reported(rows: DataFrame, shared: Broadcast, only_leaks: bool = False) -> DataFrame:
    """All columns of ``rows`` but the text, with what each text holds of a block of items."""
    names = [name for name in rows.columns if name != "text"]
    key = ("benchmark", uuid.uuid4().hex)

    def run(batches: Batches) -> Batches:
        index = kept(key, lambda: Benchmark(shared.value))
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [index.leaks(text) for text in batch.column("text").to_pylist()]
                out = pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(name) for name in names],
                        pa.array([len(leaks) for leaks in found], pa.int64()),
                        pa.array([[index.ids[i] for i in leaks if index.ids[i] is not None] for leaks in found], pa.list_(pa.int64())),
                        pa.array([max(leaks.values(), default=0.0) for leaks in found], pa.float64()),
                    ],
                    [*names, "n_items", "item_ids", "similarity"],
                )
                yield out.filter(pa.array([bool(leaks) for leaks in found], pa.bool_())) if only_leaks else out

    schema = rows.drop("text").schema
    for field in T.StructType.fromDDL(_FOUND):
        schema = schema.add(field)
    return map_batches(rows, run, schema, keeps=True)


def _leaking(rows: DataFrame, blocks: Iterator[list]) -> DataFrame:
    """``(row, n_items, item_ids, similarity)`` of the rows ``(row, text)`` that hold an item of any block.

    Every block is written before the next one is read, so that one at a time takes memory.
    """
    parts = None
    for block in blocks:
        shared = rows.sparkSession.sparkContext.broadcast(block)
        part = written(_reported(rows, shared, only_leaks=True), "leaks")
        shared.unpersist()
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("row").agg(
        F.sum("n_items").alias("n_items"),
        F.flatten(F.collect_list("item_ids")).alias("item_ids"),
        F.max("similarity").alias("similarity"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number each, as a table, so that every reading gives them the same one."""
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(id, kept, n_items, item_ids, similarity)`` for each row; ``kept`` is false where an item was found.

    A null or empty text is kept; items without words are found nowhere, those of fewer than five words where
    all their words follow each other. An empty benchmark keeps all. ``item_ids`` are the ids found, in order, null
    ids left out; equal items count once. ``similarity`` is the highest one found, else 0. Rows with equal ids stay
    apart, other columns play no part, and texts of any length are read in parts.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    count, blocks = _benchmark_blocks(benchmark, item_col, item_text_col, block_words)
    if count == 1:
        found = _reported(rows, docs.sparkSession.sparkContext.broadcast(next(blocks)))
    else:
        numbered = _numbered(rows)
        leaks = _leaking(numbered.select("row", "text"), blocks)
        none = {"n_items": F.lit(0).cast("bigint"), "item_ids": F.array().cast("array<bigint>"), "similarity": F.lit(0.0)}
        joined = numbered.select("row", "id").join(leaks, "row", "left")
        found = joined.select("id", *(F.coalesce(name, other).alias(name) for name, other in none.items()))
    return found.select(
        F.col("id").alias(id_col),
        (F.col("n_items") == 0).alias("kept"),
        "n_items",
        F.array_sort(F.array_distinct("item_ids")).alias("item_ids"),
        "similarity",
    )


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the rows that ``find_leaks`` does not keep, all columns as they are."""
    names = docs.columns
    rows = docs.toDF(*[f"c{at}" for at in range(len(names))])
    at_text = f"c{names.index(text_col)}"
    count, blocks = _benchmark_blocks(benchmark, item_col, item_text_col, block_words)
    if count > 1:
        numbered = _numbered(rows)
        leaks = _leaking(numbered.select("row", F.col(at_text).cast("string").alias("text")), blocks)
        return numbered.join(leaks, "row", "left_anti").drop("row").toDF(*names)
    shared = docs.sparkSession.sparkContext.broadcast(next(blocks))
    key = ("benchmark", uuid.uuid4().hex)

    def run(batches: Batches) -> Batches:
        index = kept(key, lambda: Benchmark(shared.value))
        for whole in batches:
            for batch in slices(whole, at_text):
                clean = [not index.leaks(text) for text in batch.column(at_text).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return map_batches(rows, run, rows.schema, keeps=True).toDF(*names)
