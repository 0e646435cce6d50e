"""SimHash near-dedup against all pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
import xxhash

from tests.llm.rows import EDGE_ROWS, SF_DIR
from wickframe.llm import simhash
from wickframe.llm.registry import QUERIES


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(gram, 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """Smallest id of what links of at most four bits reach, by comparing all fingerprints."""
    prints = np.array(sorted({p for _, p in rows}), np.uint64)
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 4)[0]:
            parent[root(i)] = root(i + 1 + int(j))
    at = {int(p): root(i) for i, p in enumerate(prints)}
    least = {}
    for row_id, p in rows:
        if row_id is not None:
            least[at[p]] = min(row_id, least.get(at[p], row_id))
    return {(row_id, f"{p:016x}", least.get(at[p])) for row_id, p in rows}


def answers(df):
    return {(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()}


def test_any_four_positions_hold_a_triple():
    assert len(simhash.TRIPLES) == len(set(simhash.TRIPLES)) == 20
    for four in combinations(range(8), 4):
        assert any(set(triple) <= set(four) for triple in simhash.TRIPLES)


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A b\tC", "a b c d", "a b c d e f g a b c d", "é  Ü x y z \x1c w"])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    monkeypatch.setattr(simhash, "_PIECE", 100)
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_whole_table(spark):
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = QUERIES["op13_simhash"](spark, SF_DIR)
    assert found.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert found.count() == len(rows)
    assert answers(found) == slow_components(rows)


def test_odd_rows(spark, documents):
    found = simhash.near_duplicates(documents(EDGE_ROWS))
    assert found.count() == len(EDGE_ROWS)
    assert answers(found) == slow_components([(row_id, slow_fingerprint(text)) for row_id, text in EDGE_ROWS])


def test_empty_table(spark, documents):
    assert simhash.near_duplicates(documents([])).collect() == []


def test_columns_with_clashing_names(spark):
    clash = "doc_id bigint, text string, id bigint, node bigint, component bigint, fingerprint string, key bigint"
    rows = spark.createDataFrame([(1, "a b c d", 9, 9, 9, "x", 9), (2, "A b c d", 8, 8, 8, "y", 8)], clash)
    assert {r.component_id for r in simhash.near_duplicates(rows).collect()} == {1}


def _nodes(spark, prints):
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    return spark.createDataFrame([(value,) for value in signed], "node bigint")


def _components(spark, prints):
    found = {r.node: r.component for r in simhash.linked_fingerprints(_nodes(spark, prints)).collect()}
    groups = {}
    for value in np.array(prints, np.uint64).view(np.int64).tolist():
        groups.setdefault(found.get(value, value), set()).add(value & (1 << 64) - 1)
    return sorted(map(sorted, groups.values()))


def _slow_groups(prints):
    groups = {}
    for row_id, p in enumerate(prints):
        groups.setdefault(row_id, p)
    by = {}
    for row_id, text, least in slow_components(list(enumerate(prints))):
        by.setdefault(least, set()).add(int(text, 16))
    return sorted(map(sorted, by.values()))


@pytest.mark.parametrize("spread", [3, 6, 16, 30])
def test_long_lists_lose_no_link(spark, monkeypatch, spread):
    """Fingerprints that share four bytes, so lists are long, in small blocks over several partitions."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "SHORT", 4)
    draw = np.random.default_rng(spread)
    flips = draw.integers(0, 32, (600, spread))
    prints = {0x1234567800000000 ^ sum(1 << int(bit) for bit in set(row)) for row in flips.tolist()}
    prints |= set(draw.integers(0, 1 << 63, 200, np.uint64).tolist())
    prints = sorted(prints)
    assert _components(spark, prints) == _slow_groups(prints)


def test_a_chain_is_one_component(spark):
    """Neighbours differ in four bits, ends in all."""
    prints = [0]
    for start in range(0, 64, 4):
        prints.append(prints[-1] ^ 0xF << start)
    assert _components(spark, prints) == [sorted(prints)]


def test_five_bits_are_too_many(spark):
    assert len(_components(spark, [0, 0b11111, 1 << 63 | 1 << 40 | 1 << 33 | 1 << 20 | 1 << 9])) == 3


def test_blocks_meet_in_proportion_to_what_is_outside(spark, monkeypatch):
    """A group whose lists are one component leaves no blocks to compare."""
    monkeypatch.setattr(simhash, "BLOCK", 32)
    prints = [0xAB << 32 | i for i in range(2000)]
    nodes = _nodes(spark, prints)
    index = simhash._indexed(simhash._postings(nodes))
    blocks = index.where("members is not null").select("key", "members")
    one = nodes.selectExpr("node", "0L as component")
    assert simhash._unresolved(blocks, one).count() == 0
