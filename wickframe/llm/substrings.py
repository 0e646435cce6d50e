"""Operator 8: passages of many words that occur more than once in the corpus.

A window is ``size`` consecutive words of one text; words in a window that also starts elsewhere are
removed. Windows are found again by hashes of 128 bits in all, one of the whole window and one of its
anchor: the window's ``SUB`` words in a row with the lowest hash, the leftmost of equal ones. Equal
windows have equal anchors at equal places, so an anchor occurs at least as often as any of its windows,
while there are ten times fewer anchors than windows.

1. A count-min sketch counts anchors: tasks count theirs, and Spark merges the counters. Counters are shared by
   chance, so they are never too low.
2. Windows whose anchor's counter reaches two are grouped by their hashes and counted exactly; all others occur
   once. Nothing is lost, and few windows that occur once are shuffled.

The sketch is a table of the counters that are not zero, so its width costs nothing and follows the corpus:
:func:`sketch_width` keeps single anchors that share a counter below one in a thousand at any size. Nobody holds the
sketch whole. Anchors are joined to it, and texts get back the counters of theirs that are high.

Counting starts on the map side, so a passage of half the corpus is one row for each task. Each count
also keeps the lowest text and start, which is the place of the window where it occurs once. Those few
places are taken from the lists of windows that each text has; what is left is repeated. No window is
joined with its occurrences.

Texts that occur more than once word for word are repeated wholly; of those one text stands for all, and
its windows count twice.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.llm.bitmaps import broadcast_bits, holds
from wickframe.llm.runtime import Batches, map_batches, slices, written
from wickframe.llm.sketches import word_hashes

SIZE = 35
SUB = 16
# Counters for each byte of text; there is an anchor for some 80 bytes.
WIDTH_PER_BYTE = 32
# Counters that hold more than this part of all anchors are joined by broadcast: there are at most that many.
HOT_COUNTERS = 1000
# Bits of the filters that pick texts before a join does; fixed, whatever the number of texts. Fuller filters pick more.
FILTER_BITS = 1 << 26

_A, _B, _C = (np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))
_SHIFT = np.uint64(32)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    values = (left * _A + right) * _B
    values ^= values >> _SHIFT
    values *= _C
    return values ^ (values >> _SHIFT)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` items, joined from runs whose lengths are powers of two."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    block, length, done, result = hashes, 1, 0, None
    while True:
        if size & length:
            part = block[done : done + count]
            result = part if result is None else _join(result, part)
            done += length
        if done == size:
            return result
        block = _join(block[:-length], block[length:])
        length *= 2


def anchors(hashes: np.ndarray, size: int, sub: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place and the hash of its anchor."""
    subs = rolling(hashes, sub)
    views = np.lib.stride_tricks.sliding_window_view(subs, size - sub + 1)
    places = views.argmin(axis=1) + np.arange(len(views))
    return places, subs[places]


def sketch_width(size: int) -> int:
    """Counters of the sketch for texts of ``size`` bytes in all, a power of two."""
    return 1 << max(10, (size * WIDTH_PER_BYTE).bit_length())


def counters(values: np.ndarray, width: int) -> np.ndarray:
    """The counter of each anchor."""
    return (_join(values, values) % np.uint64(width)).astype(np.int64)


def _sub(size: int) -> int:
    return max(1, min(SUB, size - 1))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _read(texts: DataFrame, size: int, width: int, carried: tuple[str, ...], marked: Broadcast | None = None) -> DataFrame:
    """``carried`` columns with ``n_words``, ``kept_sha256`` of all words, and the counters of the text's anchors.

    An anchor that lies at several places is counted for each. Texts that are marked as copies have none here.
    """

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, digests, found = [], [], []
                copy = holds(marked.value, batch.column("place").to_numpy()) if marked else np.zeros(batch.num_rows, bool)
                for text, skipped in zip(batch.column("text").to_pylist(), copy.tolist()):
                    words = _words(text)
                    counts.append(len(words))
                    digests.append(sha256(b" ".join(words)).digest())
                    if skipped or len(words) < size:
                        found.append(np.zeros(0, np.int64))
                        continue
                    places, values = anchors(word_hashes(words), size, _sub(size))
                    found.append(counters(values[np.r_[True, places[1:] != places[:-1]]], width))
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name) for name in carried]
                    + [pa.array(counts, pa.int64()), pa.array(digests, pa.binary())]
                    + [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *found])))],
                    [*carried, "n_words", "kept_sha256", "counters"],
                )

    schema = texts.select(*carried).schema.add("n_words", "long").add("kept_sha256", "binary")
    schema = schema.add("counters", T.ArrayType(T.LongType()))
    return map_batches(texts.select(*carried, "text", *(["place"] if marked else [])), run, schema)


def _high(read: DataFrame) -> DataFrame:
    """``(key, high)``: the counters of a text's anchors that reach two.

    Counting starts on the map side. Counters of passages that very many texts have are no hot keys of the join.
    """
    held = read.select(F.explode("counters").alias("counter"), "copies")
    counted = written(held.groupBy("counter").agg(F.sum("copies").alias("times")).where("times > 1"), "sketch")
    whole = counted.agg(F.sum("times")).first()[0] or 0
    hot = F.broadcast(counted.where(F.col("times") * HOT_COUNTERS > whole).select("counter"))
    rows = read.select(_key().alias("key"), F.explode(F.array_distinct("counters")).alias("counter"))
    few = rows.join(hot, "counter", "left_anti").join(counted.select("counter"), "counter", "left_semi")
    many = rows.join(hot, "counter", "left_semi")
    return few.unionByName(many).groupBy("key").agg(F.collect_list("counter").alias("high"))


def _key() -> Column:
    """Names a text in joins. Two that share a key share their high counters, and have more windows grouped."""
    return F.xxhash64("id", "text_hash")


_LISTS = {"starts": pa.int32(), "windows": pa.int64(), "anchors": pa.int64()}


def _windows(texts: DataFrame, size: int, width: int) -> DataFrame:
    """``(id, text_hash, copies)`` with starts, hashes and anchors of the windows whose anchor's counter is high."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                lists: list[list[np.ndarray]] = [[] for _ in _LISTS]
                for text, high in zip(batch.column("text").to_pylist(), batch.column("high").to_pylist()):
                    words = _words(text)
                    found = [np.zeros(0, np.int64)] * 3
                    if len(words) >= size:
                        hashes = word_hashes(words)
                        _, values = anchors(hashes, size, _sub(size))
                        starts = np.nonzero(np.isin(counters(values, width), np.array(high, np.int64)))[0]
                        found = [starts, rolling(hashes, size)[starts].view(np.int64), values[starts].view(np.int64)]
                    for column, part in zip(lists, found):
                        column.append(part)
                ends = pa.array(np.cumsum([0, *map(len, lists[0])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(name) for name in ("id", "text_hash", "copies")]
                    + [
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(column)).cast(kind))
                        for column, kind in zip(lists, _LISTS.values())
                    ],
                    ["id", "text_hash", "copies", *_LISTS],
                )

    schema = texts.select("id", "text_hash", "copies").schema
    for name, kind in (("starts", T.IntegerType()), ("windows", T.LongType()), ("anchors", T.LongType())):
        schema = schema.add(name, T.ArrayType(kind))
    return map_batches(texts.select("id", "text_hash", "copies", "text", "high"), run, schema)


def _place(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("bigint") % FILTER_BITS


def _copied(docs: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Digests of the texts that occur more than once, and a bitmap of fixed size that holds them."""
    copied = written(docs.groupBy("digest").count().where("count > 1").select("digest"), "copies")
    return copied, broadcast_bits(copied.select(_place(F.col("digest")).alias("place")), "place", FILTER_BITS)


def _one_of_each(docs: DataFrame, marked: Broadcast) -> DataFrame:
    """``(text, copies, id, text_hash)`` of the marked texts, equal ones as one row.

    Copies are joined to one row before they are shuffled. Only a text that has no copy keeps its id.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            wanted = holds(marked.value, batch.column("place").to_numpy())
            yield batch.filter(pa.array(wanted))

    texts = map_batches(docs, run, docs.schema).groupBy("digest").agg(
        F.count("*").alias("copies"),
        F.min("text").alias("text"),
        F.min("id").alias("id"),
        F.min("text_hash").alias("text_hash"),
    )
    return texts.select("text", "copies", "id", "text_hash")


def _cut(texts: DataFrame, size: int) -> DataFrame:
    """``(id, text_hash, n_removed, kept_sha256)`` from texts and the starts of their repeated windows."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                removed, kept = [], []
                for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                    words = _words(text)
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, np.array(starts), 1)
                    np.add.at(edges, np.array(starts) + size, -1)
                    gone = np.cumsum(edges)[:-1] > 0
                    removed.append(int(gone.sum()))
                    kept.append(sha256(b" ".join([word for word, out in zip(words, gone.tolist()) if not out])).digest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("text_hash"), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                    ["id", "text_hash", "n_removed", "kept_sha256"],
                )

    return map_batches(texts, run, "id bigint, text_hash bigint, n_removed bigint, kept_sha256 binary")


def _repeated(read: DataFrame) -> DataFrame:
    """``(id, text_hash, starts)`` of the windows that occur more than once, in texts that occur once."""
    at = F.explode(F.arrays_zip(*_LISTS)).alias("at")
    windows = read.select("id", "text_hash", "copies", at).select("id", "text_hash", "copies", "at.*")
    # Of a window that occurs once, these are the columns of its one row.
    place = [F.min("id").alias("id"), F.min("text_hash").alias("text_hash"), F.min("starts").alias("start")]
    once = windows.groupBy("windows", "anchors").agg(F.sum("copies").alias("times"), *place).where("times = 1")
    alone = once.groupBy(F.col("id").alias("id_alone"), F.col("text_hash").alias("hash_alone")).agg(
        F.collect_list("start").alias("alone")
    )
    listed = read.where("copies = 1 and size(starts) > 0").select("id", "text_hash", "starts")
    same = F.col("id").eqNullSafe(F.col("id_alone")) & (F.col("text_hash") == F.col("hash_alone"))
    left = F.array_except("starts", F.coalesce("alone", F.array().cast("array<int>"))).alias("starts")
    return listed.join(alone, same, "left").select("id", "text_hash", left).where("size(starts) > 0")


def _marked(docs: DataFrame, found: DataFrame, without: Broadcast | None = None) -> DataFrame:
    """Texts whose key may be in ``found``, by a bitmap of fixed size; a join decides.

    Texts marked in ``without`` are left out; one of each stands for them elsewhere.
    """
    place = F.pmod("key", F.lit(FILTER_BITS))
    shared = broadcast_bits(found.select(place.alias("place")), "place", FILTER_BITS)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            wanted = holds(shared.value, np.mod(batch.column("key").to_numpy(), FILTER_BITS))
            if without:
                wanted &= ~holds(without.value, batch.column("place").to_numpy())
            yield batch.filter(pa.array(wanted)).drop_columns(["place"])

    keyed = docs.select("id", "text_hash", "text", _key().alias("key"), "place")
    return map_batches(keyed, run, "id bigint, text_hash bigint, text string, key bigint")


def repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, width: int | None = None
) -> DataFrame:
    """``(id, n_words, n_removed, kept_sha256)`` for each row: words, those removed, digest of the rest.

    A word goes if a window of ``size`` words that covers it starts anywhere else too, in the same text
    or another; repeated rows are other texts. Windows are those of the texts as given. Texts of fewer
    words than a window, empty and null ones lose nothing; null counts as empty. The rest is hashed as
    words joined by one blank. ``size`` is at least 2. ``width`` is the sketch's; it changes how much is
    grouped, not the result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(
        F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"), F.unhex(F.md5(text)).alias("digest")
    )
    if width is None:
        width = sketch_width(given.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    copied, marked = _copied(given)
    placed = given.withColumn("place", _place(F.col("digest")))
    rows = written(_read(placed, size, width, ("id", "text_hash", "digest"), marked), "read-texts")
    texts = written(_one_of_each(placed, marked), "copied-texts")
    one_of_each = written(_read(texts, size, width, ("id", "text_hash", "copies")), "read-copies")

    columns = ["id", "text_hash", "copies", "counters"]
    read = rows.withColumn("copies", F.lit(1).cast("bigint")).select(columns).union(one_of_each.select(columns))
    high = written(_high(read), "high-counters")
    single = _marked(placed, high, without=marked).withColumn("copies", F.lit(1).cast("bigint"))
    found = single.unionByName(texts.withColumn("key", _key()))
    windows = written(_windows(found.join(high, "key"), size, width), "windows")
    starts = written(_repeated(windows), "starts")

    wanted = _marked(placed, starts.select(_key().alias("key"))).drop("key")
    same = wanted["id"].eqNullSafe(starts["id"]) & (wanted["text_hash"] == starts["text_hash"])
    cut = _cut(wanted.join(starts, same).select(wanted["*"], "starts"), size)
    cut = cut.select(
        F.col("id").alias("cut_id"), F.col("text_hash").alias("cut_hash"), "n_removed", F.col("kept_sha256").alias("cut_sha256")
    )
    counted = rows.select("id", "text_hash", "digest", "n_words", "kept_sha256")
    joined = counted.join(copied.withColumn("copy", F.lit(True)), "digest", "left")
    joined = joined.join(cut, joined["id"].eqNullSafe(cut["cut_id"]) & (joined["text_hash"] == cut["cut_hash"]), "left")
    whole = F.col("copy") & (F.col("n_words") >= size)
    kept = F.when(whole, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("cut_sha256", "kept_sha256"))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(kept)).alias("kept_sha256"),
    )
