"""Operator 13: near duplicates by SimHash, found in a byte-position inverted index with count filtering.

Fingerprints have 64 bits, eight bytes at eight positions. Two that differ in four bits or fewer have at least
four bytes in common at the same positions: the guaranteed number of matches. Lists of single bytes would hold a
256th of all fingerprints each, so the index lists triples: 20 triples of positions are enough that any four
positions hold one (:data:`TRIPLES`), and a list has one in 16 million.

1. Texts become fingerprints, and equal ones are one node from then on.
2. Postings ``(triple and its bytes, fingerprint)`` are sorted over all partitions by both, so that a long list
   lies over several partitions and none gets it whole. Tasks go through them in order. Pairs that meet in a list
   are tallied: their common positional bytes are counted, those with four or more are kept and verified on
   all 64 bits.
3. Lists of more than ``BLOCK`` fingerprints, and those at the ends of a partition, become blocks of fingerprints.
   Inside a block all are compared at once; then each block of a list meets the list's first; then, where a list
   still has several components, what is outside the largest meets all blocks of the list, one row for two
   blocks, dealt over both. What one component holds is not compared again.
4. Links inside a block are given as a star for each component of the block, so none has more than ``BLOCK`` rows.
   Components grow by contraction (:mod:`wickframe.llm.components`).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.components import contracted, joined_with_hot_keys
from wickframe.llm.runtime import Batches, map_batches, slices, written
from wickframe.session import scoped_conf

SHINGLE = 4
RADIUS = 4
SEED = 42
POSITIONS = 8
# Bytes that two fingerprints within the radius share at least.
MATCHES = POSITIONS - RADIUS
# Fingerprints in a block, and the longest list that is compared row by row.
BLOCK = 2048
SHORT = 32
# Hashes whose bits are counted at once.
_PIECE = 1 << 16
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


def _triples() -> list[tuple[int, int, int]]:
    """Triples of positions so that any four positions hold one of them.

    Positions lie in three groups in a ring. A triple inside one group counts, and so do two of a group with
    one of the next: four positions have three in one group, or two in one and some in the next.
    """
    groups = [range(0, 3), range(3, 6), range(6, POSITIONS)]
    inside = [triple for group in groups for triple in combinations(group, 3)]
    across = [
        (*pair, other) for at, group in enumerate(groups) for pair in combinations(group, 2) for other in groups[(at + 1) % 3]
    ]
    return [tuple(sorted(triple)) for triple in inside + across]


TRIPLES = _triples()


def _first_triples() -> np.ndarray:
    """For each set of common positions, as bits, the first triple in it; -1 for none."""
    first = np.full(1 << POSITIONS, -1, np.int64)
    for common in range(1 << POSITIONS):
        for number, triple in enumerate(TRIPLES):
            if all(common >> position & 1 for position in triple):
                first[common] = number
                break
    return first


_FIRST = _first_triples()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each one if more than half of the shingles' hashes have it; zero for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.append(np.nonzero(np.frombuffer(joined, np.uint8) == 32)[0], len(joined))
    starts = np.append(0, ends[:-1] + 1)
    many = max(1, len(words) - shingle + 1)
    starts, ends = starts[:many].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, many, _PIECE):
        some = [hashed(joined[s:e], SEED) for s, e in zip(starts[at : at + _PIECE], ends[at : at + _PIECE])]
        hashes = np.array(some, "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > many, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, node)`` for each row; ``node`` is the fingerprint as a signed number."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = np.array([fingerprint(text, shingle) for text in batch.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "node"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "id bigint, node bigint")


def posting_keys(nodes: np.ndarray) -> np.ndarray:
    """A row of keys for each fingerprint: number of the triple, then its three bytes."""
    octets = np.ascontiguousarray(nodes.astype("<i8")).view(np.uint8).reshape(-1, POSITIONS).astype(np.int64)
    keys = [number << 24 | octets[:, a] << 16 | octets[:, b] << 8 | octets[:, c] for number, (a, b, c) in enumerate(TRIPLES)]
    return np.stack(keys, axis=1)


def common_positions(differing: np.ndarray) -> np.ndarray:
    """The positions whose bytes are equal, as bits, from the exclusive or of two fingerprints."""
    equal = np.ascontiguousarray(differing).view(np.uint8).reshape(-1, POSITIONS) == 0
    return np.packbits(equal, axis=1, bitorder="little")[:, 0]


def close(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Count filter, then check of all bits: which pairs lie within the radius."""
    differing = np.bitwise_xor(left, right)
    kept = np.bitwise_count(common_positions(differing)) >= MATCHES
    kept[kept] = np.bitwise_count(differing[kept].view(np.uint64)) <= RADIUS
    return kept


def _short_links(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius in short lists that lie one after another; each in its first common list only."""
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.arange(len(keys))
    for step in range(1, SHORT):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        differing = np.bitwise_xor(nodes[at], nodes[at + step])
        common = common_positions(differing)
        kept = (np.bitwise_count(common) >= MATCHES) & (_FIRST[common] == keys[at] >> 24)
        kept[kept] = np.bitwise_count(differing[kept].view(np.uint64)) <= RADIUS
        found_a.append(nodes[at[kept]])
        found_b.append(nodes[at[kept] + step])
    return np.concatenate(found_a), np.concatenate(found_b)


def _near(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Table of who is within the radius of whom, made in strips of bounded size."""
    table = np.empty((len(left), len(right)), bool)
    strip = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), strip):
        some = left[at : at + strip]
        pairs = close(np.repeat(some, len(right)), np.tile(right, len(some)))
        table[at : at + strip] = pairs.reshape(len(some), len(right))
    return table


def stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs between two sets of fingerprints join: member and smallest of its component."""
    near = _near(left, right)
    reached = [np.zeros(len(left), bool), np.zeros(len(right), bool)]
    a, b = [], []
    for start in np.nonzero(near.any(axis=1))[0]:
        if reached[0][start]:
            continue
        rows, columns = np.zeros(len(left), bool), np.zeros(len(right), bool)
        new = np.array([start])
        while len(new):
            rows[new] = True
            fresh = near[new].any(axis=0) & ~columns
            columns |= fresh
            new = np.nonzero(near[:, fresh].any(axis=1) & ~rows)[0]
        members = np.unique(np.concatenate([left[rows], right[columns]]))
        a.append(members[1:])
        b.append(np.full(len(members) - 1, members[0]))
        reached[0] |= rows
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a + none), np.concatenate(b + none)


def _postings(nodes: DataFrame) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = batch.column("node").to_numpy()
            keys = posting_keys(found)
            arrays = [pa.array(keys.ravel()), pa.array(np.repeat(found, keys.shape[1]))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "node"])

    rows = map_batches(nodes.select("node"), run, "key bigint, node bigint")
    return rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")


def _indexed(postings: DataFrame) -> DataFrame:
    """``(key, members, a, b)``: links of lists that are whole and short, members of the others in blocks.

    Rows come in order. A list at an end of the partition may go on in another one, so it becomes blocks too.
    """
    names = ["key", "members", "a", "b"]

    def linked(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.binary())]
        return pa.RecordBatch.from_arrays([*none, pa.array(a), pa.array(b)], names)

    def blocks(key: int, members: np.ndarray) -> pa.RecordBatch:
        parts = [members[at : at + BLOCK].tobytes() for at in range(0, len(members), BLOCK)]
        none = [pa.nulls(len(parts), pa.int64())] * 2
        return pa.RecordBatch.from_arrays([pa.array([key] * len(parts), pa.int64()), pa.array(parts, pa.binary()), *none], names)

    def run(batches: Batches) -> Batches:
        held_keys, held_nodes, cut = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy()])
            nodes = np.concatenate([held_nodes, batch.column("node").to_numpy()])
            if not len(keys):
                continue
            cut = keys[0] if cut is None else cut
            starts = np.nonzero(np.diff(keys, prepend=-1))[0]
            sizes = np.diff(np.append(starts, len(keys)))
            long = sizes > SHORT
            long[0] |= keys[0] == cut  # others have rows of this list, or had them
            long[-1] = False  # the last list may go on
            for start, size in zip(starts[long].tolist(), sizes[long].tolist()):
                yield blocks(int(keys[start]), nodes[start : start + size])
            short = ~long & (sizes > 1)
            short[-1] = False
            rows = np.repeat(short, sizes)
            if rows.any():
                yield linked(*_short_links(keys[rows], nodes[rows]))
            held_keys, held_nodes = keys[starts[-1] :], nodes[starts[-1] :]
            while len(held_nodes) > BLOCK:  # a list of any length goes out block by block
                yield blocks(int(held_keys[0]), held_nodes[:BLOCK])
                cut = held_keys[0]
                held_keys, held_nodes = held_keys[BLOCK:], held_nodes[BLOCK:]
        if len(held_nodes):
            yield blocks(int(held_keys[0]), held_nodes)

    return map_batches(postings, run, "key bigint, members binary, a bigint, b bigint")


def _compared(rows: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the fingerprints of two blocks in a row, as stars."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                a, b = stars(np.frombuffer(left, np.int64), np.frombuffer(right, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_batches(rows.select("left", "right"), run, "a bigint, b bigint").distinct()


def _exploded(blocks: DataFrame) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for key, members in zip(batch.column("key").to_pylist(), batch.column("members").to_pylist()):
                nodes = np.frombuffer(members, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), key)), pa.array(nodes)], ["key", "node"])

    return map_batches(blocks.select("key", "members"), run, "key bigint, node bigint")


def _unresolved(blocks: DataFrame, components: DataFrame) -> DataFrame:
    """Two blocks in a row: fingerprints outside their list's largest component, and any of that list.

    Nothing else of a list can still be linked and unknown. Blocks are dealt out by key and both numbers.
    """
    placed = written(_exploded(blocks).join(components, "node"), "simhash-placed")
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    lists = parts.groupBy("key").agg(
        F.count("*").alias("parts"), F.sum("size").alias("whole"), F.max(F.struct("size", "component")).alias("largest")
    )
    lists = lists.where("parts > 1").select(
        "key",
        F.col("largest.component").alias("main"),
        F.ceil((F.col("whole") - F.col("largest.size")) / BLOCK).alias("lefts"),
        F.ceil(F.col("whole") / BLOCK).alias("rights"),
    )
    rows = placed.join(lists, "key")
    draw = F.xxhash64("node")

    def gathered(some: DataFrame, count: str, number: str, others: str, other: str, name: str) -> DataFrame:
        some = some.withColumn(number, F.pmod(draw, F.col(count)))
        some = some.groupBy("key", number, others).agg(F.collect_list("node").alias(name))
        return some.select("key", number, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1)).alias(other), name)

    left = gathered(rows.where("component <> main"), "lefts", "i", "rights", "j", "left")
    right = gathered(rows, "rights", "j", "lefts", "i", "right")
    return left.join(right, ["key", "i", "j"])


def _as_bytes(rows: DataFrame) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            sides = [pa.array([np.array(row, np.int64).tobytes() for row in batch.column(side).to_pylist()], pa.binary()) for side in ("left", "right")]
            yield pa.RecordBatch.from_arrays(sides, ["left", "right"])

    return map_batches(rows.select("left", "right"), run, "left binary, right binary")


def linked_fingerprints(nodes: DataFrame) -> DataFrame:
    """``(node, component)`` of distinct fingerprints: what links of at most ``RADIUS`` bits reach; no link is missed."""
    spark = nodes.sparkSession
    index = written(_indexed(_postings(nodes)), "simhash-index")
    links = [index.where("a is not null").select("a", "b")]
    blocks = index.where("members is not null").select("key", "members")
    counts = blocks.groupBy("key").agg(F.count("*").alias("blocks"), F.min("members").alias("first"))
    with scoped_conf(spark, _BATCHES):
        # Inside each block, and where a list has several, with its first one.
        inside = blocks.select(F.col("members").alias("left"), F.col("members").alias("right")).where(F.length("members") > 8)
        met = blocks.join(counts.where("blocks > 1"), "key").where("members <> first")
        met = met.select(F.col("first").alias("left"), F.col("members").alias("right"))
        links.append(written(_compared(inside.unionByName(met)), "simhash-links"))
    all_links = written(links[0].unionByName(links[1]).distinct(), "simhash-links")
    ends = all_links.select(F.col("a").alias("node")).union(all_links.select(F.col("b").alias("node"))).distinct()
    several = written(blocks.join(counts.where("blocks > 1").select("key"), "key"), "simhash-blocks")
    if several.isEmpty():
        return contracted(ends.select("node", F.col("node").alias("component")), all_links)
    with scoped_conf(spark, _BATCHES):
        members = _exploded(several).select("node")
        start = written(ends.union(members).distinct().select("node", F.col("node").alias("component")), "simhash-start")
        components = contracted(start, all_links)
        rest = written(_compared(_as_bytes(_unresolved(several, components))), "simhash-links")
    return contracted(components, rest)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fingerprint, component_id)`` for each row of ``docs``.

    Texts with A-Z in lower case are cut into words; fingerprints are made of all shingles of ``shingle`` words,
    repeats counted, a shorter text being one shingle. Texts without words, null ones too, have fingerprint zero,
    which links like any other. ``component_id`` is the smallest id that links reach, the row's own included; a
    null id is passed over unless a component has no other. Repeated rows share their component. Texts of any
    length are read whole, in pieces; other columns of ``docs`` play no part; an empty table has no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    nodes = written(rows.groupBy("node").agg(F.min("id").alias("id")), "simhash-nodes")
    components = linked_fingerprints(nodes)
    named = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named, "simhash-named")
    smallest = written(named.groupBy("component").agg(F.min("id").alias("component_id")), "simhash-smallest")
    of_node = written(joined_with_hot_keys(named.select("node", "component"), smallest, "component").select("node", "component_id"), "simhash-of-node")
    found = joined_with_hot_keys(rows, of_node, "node")
    # Spark's hex of a signed number is that of its 64 bits.
    digits = F.lower(F.lpad(F.hex("node"), 16, "0"))
    return found.select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")
