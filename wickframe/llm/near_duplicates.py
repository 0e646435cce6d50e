"""Operator 5: near duplicates by SetSketch bands, joint likelihood estimates and a check of whole sets.

1. Each text becomes a set of shingles, named by a digest of the set, so that texts with equal sets are
   one node from then on.
2. Bands of registers put nodes into buckets. At similarity 0.8 a pair misses all ``BANDS`` buckets with
   a chance of about 1 in 10 million; every other pair is looked for to the end.
3. Links are looked for in three rounds. First each member meets one node of its bucket; then, where a
   bucket still has several components, the members outside the largest meet a random node of it in each
   bucket. A pair is dropped where the likelihood of its registers peaks five standard errors below the
   wanted similarity; the others are confirmed on their whole sets.
4. Members that are still outside may be linked to any other of their buckets, and no link may be lost. What is
   left there is narrowed down by prefixes: in one order of all shingles, rare ones first, two sets that are
   similar enough share a shingle among their first ones, so only members of one such list and of different
   components meet. Texts that are alike without being linked share none, however many they are. Lists of
   more than ``SHORT`` members are compared in blocks: nodes get a home, a block of about ``BLOCK`` nodes, and the sets of
   two homes that meet in a list are compared in one row. Again, what may be a link is confirmed on whole sets.
5. Components grow by contraction: every component points to a smaller one it is linked to, pointers are
   followed to their ends, and links are renamed, until none joins two components.

A node that many pairs have in common, such as the first of a large bucket, is no hot key: its rows are salted
(:func:`wickframe.llm.components.salted_join`). Everything stays in tables; no link, component or set passes the
driver. Tables that are read more than once are written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm import sketches
from wickframe.llm.bitmaps import broadcast_bits
from wickframe.llm.components import contracted, salted_join
from wickframe.llm.runtime import Batches, map_batches, slices, written
from wickframe.session import scoped_conf

SIMILARITY_PERCENT = 80
BANDS = 40
ROWS = 5
# Five standard errors of an estimate from 200 registers lie between this and 0.8.
LOWEST_ESTIMATE = 0.66
# Nodes in a home on average, and rows of two homes in an Arrow batch.
BLOCK = 32
BATCH = 16
# Members of a list of one shingle that meet each other pair by pair.
SHORT = 32
# Counters of the sketch that orders shingles by how many sets have them. Any order is right; a fuller sketch
# tells rare from common less sharply. It is broadcast, and never larger than this.
ORDER_SLOTS = 1 << 20
# Bits of the filter of nodes whose sets are wanted; fixed, so what is broadcast does not grow.
FILTER_BITS = 1 << 26


def _digest(members: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None


def _named(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, text_hash, n, node, registers)`` for each row; no node where the text has no word."""
    factors = sketches.multipliers(BANDS * ROWS)

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, "text"):
                sizes, nodes, registers = [], [], []
                known: dict[bytes, bytes] = {}
                for text in batch.column("text").to_pylist():
                    members = sketches.shingle_set(text, shingle)
                    node = _digest(members)
                    if node is not None and node not in known:
                        known[node] = sketches.sketch(members, factors).tobytes()
                    sizes.append(len(members))
                    nodes.append(node)
                    registers.append(known.get(node) if node is not None else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        batch.column("text_hash"),
                        pa.array(sizes, pa.int64()),
                        pa.array(nodes, pa.binary()),
                        pa.array(registers, pa.binary()),
                    ],
                    ["id", "text_hash", "n", "node", "registers"],
                )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    )
    return map_batches(rows, run, "id bigint, text_hash bigint, n bigint, node binary, registers binary")


def _banded(nodes: DataFrame) -> DataFrame:
    """``(key, node, n)``: a row for each band of each node."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            stacked = _registers(batch.column("registers"))
            keys = sketches.band_keys(stacked, ROWS)
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), lists], ["node", "n", "keys"])

    keyed = map_batches(nodes.select("node", "n", "registers"), run, "node binary, n bigint, keys array<bigint>")
    return keyed.select(F.explode("keys").alias("key"), "node", "n")


def _registers(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint16).reshape(len(column), -1)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and registers allow the wanted similarity."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            n_a, n_b = (batch.column(name).to_numpy().astype(np.float64) for name in ("n_a", "n_b"))
            if batch.num_rows:
                found = sketches.estimate(_registers(batch.column("r_a")), _registers(batch.column("r_b")), n_a, n_b)
                keep = pa.array(found >= LOWEST_ESTIMATE * percent / SIMILARITY_PERCENT)
                batch = batch.filter(keep)
            yield batch.select(["a", "b"])

    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    sizes = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    pairs = written(pairs, "near-pairs")
    joined = salted_join(salted_join(pairs, left, "a", "b"), right, "b", "a", pairs).where(sizes)
    return map_batches(joined.select("a", "b", "n_a", "n_b", "r_a", "r_b"), run, "a binary, b binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """``(node, members)`` of the wanted nodes, from the texts.

    A filter of ``FILTER_BITS`` bits over the wanted digests keeps most other sets from being shuffled;
    the join decides. When the filter fills up, more sets are shuffled, and the result is the same.
    """

    place = F.conv(F.hex(F.substring("node", 1, 6)), 16, 10).cast("bigint") % FILTER_BITS
    shared = broadcast_bits(wanted.select(place.alias("place")), "place", FILTER_BITS)

    def run(batches: Batches) -> Batches:
        marked = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                found: dict[bytes, bytes] = {}
                for text in batch.column("text").to_pylist():
                    members = sketches.shingle_set(text, shingle)
                    node = _digest(members)
                    if node is None or node in found:
                        continue
                    place = int.from_bytes(node[:6], "big") % FILTER_BITS
                    if marked[place >> 3] >> (place & 7) & 1:
                        found[node] = members.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())],
                    ["node", "members"],
                )

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    sets = map_batches(texts, run, "node binary, members binary")
    return sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("members").alias("members"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets are similar enough."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("m_a").to_pylist(), batch.column("m_b").to_pylist()):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = np.intersect1d(left, right, assume_unique=True).size
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("m_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("m_b"))
    pairs = written(pairs, "near-likely")
    joined = salted_join(salted_join(pairs, left, "a", "b"), right, "b", "a", pairs)
    return map_batches(joined.select("a", "b", "m_a", "m_b"), run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept, text_hash, first)`` for each row of ``docs``.

    Texts are linked where the similarity of their shingle sets is ``percent`` or more; a component is
    what links reach, ``component_id`` its smallest id, and ``kept`` is true for the row with that id.
    Texts of fewer words than a shingle are one shingle; texts without words, or null, are linked with
    nothing and kept. Repeated rows with one id are all kept, or none; ``first`` is true for those rows
    of a component that share its smallest ``(id, text_hash)``, which tells apart rows of one id. A null id is
    passed over as ``component_id`` unless the component has no other.

    Bands and estimates are made for similarities of ``SIMILARITY_PERCENT`` or more; a lower ``percent`` would
    lose links and is refused.
    """
    if not SIMILARITY_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be between {SIMILARITY_PERCENT} and 100")
    rows = written(_named(docs, id_col, text_col, shingle), "near-rows")
    key = F.struct("id", "text_hash")
    nodes = written(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min("n").alias("n"), F.min("id").alias("id"), F.min(key).alias("key"), F.min("registers").alias("registers")),
        "near-nodes",
    )
    banded = written(_banded(nodes), "near-bands")
    counts = banded.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1")
    members = written(banded.join(counts, "key"), "near-buckets")

    first = written(_likely(_pairs(members.where("node <> hub"), "node", "hub"), nodes, percent), "near-likely")
    wide = members.where("size > 2").select("key", "node")
    wanted = _ends(first).union(wide.select("node")).distinct()
    sets = written(_sets_of(docs, written(wanted, "near-wanted"), text_col, shingle), "near-sets")
    components = contracted(wanted.select("node", F.col("node").alias("component")), written(_linked(first, sets, percent), "near-links"))

    unresolved = _unresolved(wide, components)
    pairs = _likely(_pairs(unresolved.where("outside"), "node", "member"), nodes, percent)
    components = contracted(components, written(_linked(pairs, sets, percent), "near-links"))
    pairs = written(_left_pairs(_unresolved(wide, components), nodes, sets, percent), "near-pairs")
    components = contracted(components, written(_linked(pairs, sets, percent), "near-links"))

    named = nodes.select("node", "id", "key").join(components, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"), F.min("key").alias("least"))
    of_node = named.select("node", "component").join(smallest, "component").select("node", "component_id", "least")
    alone = F.col("node").isNull()
    return (
        rows.select("id", "text_hash", "n", "node")
        .join(of_node, "node", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            (alone | F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
            "text_hash",
            (alone | key.eqNullSafe(F.col("least"))).alias("first"),
        )
    )


def _pairs(rows: DataFrame, left: str, right: str) -> DataFrame:
    return rows.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _unresolved(wide: DataFrame, components: DataFrame) -> DataFrame:
    """Members ``(key, node, component, outside, member)`` of buckets with several components.

    ``member`` is a random node of the bucket's largest component, ``outside`` tells who is not in it.
    """
    placed = written(wide.select("key", "node").join(components, "node"), "near-placed")
    drawn = F.struct(F.xxhash64("node", "key").alias("draw"), "node")
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("size"), F.max(drawn).alias("member"))
    largest = (
        parts.groupBy("key")
        .agg(F.count("*").alias("parts"), F.max(F.struct("size", "component", "member.node")).alias("largest"))
        .where("parts > 1")
    )
    of_key = largest.select("key", F.col("largest.component").alias("main"), F.col("largest.node").alias("member"))
    return written(
        placed.join(of_key, "key").select("key", "node", "component", (F.col("component") != F.col("main")).alias("outside"), "member"),
        "near-unresolved",
    )


def _left_pairs(unresolved: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components, both in unresolved buckets, that may be linked; none is lost."""
    left = written(unresolved.select("node", "component").distinct().join(sets, "node"), "near-left")
    # A list of one component has nothing to compare.
    prefixes = written(_prefixes(left, percent), "near-prefixes")
    lists = (
        prefixes.groupBy("token")
        .agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("token", "size")
    )
    shared = written(prefixes.join(lists, "token"), "near-lists")
    short = shared.where(f"size <= {SHORT}")
    a, b = (
        short.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "rest"))) for side in "ab"
    )
    # Behind the first shingle that two sets share, each has ``rest`` more. That must do for what they have to share.
    enough = f"(100 + {percent}) * (1 + least(rest_a, rest_b)) >= {percent} * (n_a + n_b)"
    sizes = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    both = (F.col("a.token") == F.col("b.token")) & F.expr(f"node_a < node_b and component_a <> component_b and {sizes} and {enough}")
    met = a.alias("a").join(b.alias("b"), both).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    pairs = _likely(met.distinct(), nodes, percent)
    long = shared.where(f"size > {SHORT}").select(F.col("token").alias("key"), "node")
    if long.isEmpty():
        return pairs
    components = left.select("node", "component")
    with scoped_conf(nodes.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH)}):
        between = written(_near_between_homes(_unresolved(long, components), nodes, sets, percent), "near-pairs")
    return pairs.unionByName(between).distinct()


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens % np.uint64(ORDER_SLOTS)).astype(np.int64)


def _prefixes(left: DataFrame, percent: int) -> DataFrame:
    """``(token, node, component, n, rest)``: the first shingles of each set, as many as similar sets must meet in.

    A set of n shingles shares at least ``percent`` per cent of them with a similar one, so the two share one of the
    first ``n - ceil(percent * n / 100) + 1`` in any order that holds for all sets: here by counters, then by value.
    ``rest`` counts the shingles behind.
    """

    def count(batches: Batches) -> Batches:
        counters = np.zeros(ORDER_SLOTS, np.int64)
        for batch in batches:
            for part in slices(batch, "members"):
                tokens = np.frombuffer(b"".join(part.column("members").to_pylist()), np.uint64)
                counters += np.bincount(_slots(tokens), minlength=ORDER_SLOTS)
        at = np.nonzero(counters)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counters[at])], ["slot", "held"])

    # At most a row for each slot and task; numbers of slots come to the driver, whatever the tables hold.
    parts = map_batches(left.select("members"), count, "slot bigint, held bigint").groupBy("slot").agg(F.sum("held").alias("held"))
    whole = np.zeros(ORDER_SLOTS, np.int64)
    counted = parts.toArrow()
    whole[counted.column("slot").to_numpy()] = counted.column("held").to_numpy()
    shared = left.sparkSession.sparkContext.broadcast(whole.astype(np.float32))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in range(batch.num_rows):
                tokens = np.frombuffer(batch.column("members")[row].as_buffer(), np.uint64)
                size = len(tokens)
                first = size - -(-percent * size // 100) + 1
                held = shared.value[_slots(tokens)]
                chosen = tokens[np.lexsort((tokens, held))[:first]]
                same = [pa.repeat(batch.column(name)[row], len(chosen)) for name in ("node", "component")]
                counts = [pa.array(np.full(len(chosen), size)), pa.array(size - 1 - np.arange(len(chosen)))]
                yield pa.RecordBatch.from_arrays([pa.array(chosen.view(np.int64)), *same, *counts], ["token", "node", "component", "n", "rest"])

    return map_batches(left, run, "token bigint, node binary, component binary, n bigint, rest bigint")


def _near_between_homes(unresolved: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs ``(a, b)`` of different components that share an unresolved bucket and may be linked.

    A home is named by the largest unresolved bucket of its nodes, so nodes that meet often live together,
    and by the order of magnitude of their sets. Nodes that are outside somewhere live apart from those
    that never are, which need not meet each other. Homes are split by a hash, however many nodes have
    one largest bucket. Members are compared by 32 bits of their hashes, which can only overrate a pair.
    """
    sizes = unresolved.groupBy("key").agg(F.count("*").alias("size"))
    ranked = unresolved.join(sizes, "key").groupBy("node").agg(
        F.max(F.struct("size", "key")).alias("top"), F.max("outside").alias("out"), F.min("component").alias("component")
    )
    lived = ranked.join(nodes.select("node", "n"), "node").select(
        "node", "component", "n", "out", F.col("top.key").alias("top"), F.floor(F.log(1.2, F.col("n"))).alias("magnitude")
    )
    named = ["top", "out", "magnitude"]
    crowds = lived.groupBy(*named).agg(F.count("*").alias("crowd"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("crowd") / BLOCK))
    homes = written(
        lived.join(crowds, named).select("node", "component", "n", F.struct(*named, part.alias("part")).alias("home")), "near-homes"
    )
    met = written(
        unresolved.select("key", "node", "outside")
        .join(homes.select("node", "n", "home"), "node")
        .groupBy("key", "home")
        .agg(F.max("outside").alias("outside"), F.min("n").alias("low"), F.max("n").alias("high")),
        "near-met",
    )
    left, right = (
        met.select("key", F.col("home").alias(f"home_{x}"), F.col("outside").alias(f"out_{x}"), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}"))
        for x in "ab"
    )
    fitting = f"100 * high_a >= {percent} * low_b and 100 * high_b >= {percent} * low_a"
    meetings = left.join(right, "key").where(f"(out_a or out_b) and home_a <= home_b and {fitting}")
    meetings = meetings.select("home_a", "home_b").distinct()

    def shorten(batches: Batches) -> Batches:
        for batch in batches:
            short = [np.unique(np.frombuffer(m, np.uint64).astype(np.uint32)).tobytes() for m in batch.column("members").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("members"), "members", pa.array(short, pa.binary()))

    housed = homes.join(sets, "node").select("home", "node", "component", "n", "members")
    short = map_batches(housed, shorten, housed.schema)
    members = F.sort_array(F.collect_list(F.struct("node", "component", "n", "members")))
    blocks = written(short.groupBy("home").agg(members.alias("block")), "near-blocks")
    joined = meetings.join(blocks.select(F.col("home").alias("home_a"), F.col("block").alias("left")), "home_a").join(
        blocks.select(F.col("home").alias("home_b"), F.col("block").alias("right")), "home_b"
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            near: set[tuple[bytes, bytes]] = set()
            for at in range(batch.num_rows):
                near.update(_near_in_blocks(batch.column("left")[at].as_py(), batch.column("right")[at].as_py(), percent))
            a, b = zip(*sorted(near)) if near else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return map_batches(joined.select("left", "right"), run, "a binary, b binary").distinct()


def _near_in_blocks(left: list[dict], right: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Pairs of two blocks that may be linked; one search of each right set in all left sets at once.

    Shortened hashes that fall together make a set look smaller, so sizes are those of the whole sets,
    and one member of a set may stand for several: each counts for as many as were lost.
    """
    sets = [np.frombuffer(row["members"], np.uint32) for row in left]
    sizes = np.array([row["n"] for row in left])
    lost = sizes - np.array([len(members) for members in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], np.repeat(np.arange(len(sets)), [len(members) for members in sets])[order]
    near = []
    for row in right:
        members = np.frombuffer(row["members"], np.uint32)
        starts, ends = np.searchsorted(values, members, "left"), np.searchsorted(values, members, "right")
        counts = ends - starts
        places = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        both = np.bincount(owners[places], minlength=len(sets)) + np.minimum(lost, row["n"] - len(members))
        for at in np.nonzero(100 * both >= percent * (sizes + row["n"] - both))[0].tolist():
            if left[at]["component"] != row["component"]:
                near.append(tuple(sorted((left[at]["node"], row["node"]))))
    return near


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = SIMILARITY_PERCENT
) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are; rows without words all stay.

    The row with the smallest id stays, of rows with one id the one with the smallest hash of its text,
    of rows equal in both any one.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, percent)
    gone = found.where("not first").select(F.col(id_col).alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col("gone_id")) & (text_hash == F.col("gone_hash"))
    left = docs.join(gone, same, "left_anti")
    # Only rows repeated with id and text are still too many; hardly any are, and they are few each.
    again = found.where("first and n_shingles > 0").groupBy(id_col, "text_hash").count().where("count > 1")
    again = again.select(F.col(id_col).alias("again_id"), F.col("text_hash").alias("again_hash"))
    if again.isEmpty():
        return left
    repeats = F.col(id_col).cast("bigint").eqNullSafe(F.col("again_id")) & (text_hash == F.col("again_hash"))
    once = left.join(again, repeats, "left_semi").dropDuplicates([id_col, text_col])
    return left.join(again, repeats, "left_anti").unionByName(once)
