"""Operator 5 against all pairs by brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from wickframe.llm import components as joins
from wickframe.llm import near_duplicates as near
from wickframe.llm import sketches
from wickframe.llm.near_duplicates import near_duplicates, without_near_duplicates

from .rows import EDGE_ROWS, SF_DIR


def shingle_sets(rows, size):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        length = min(size, len(words))
        sets.append({tuple(words[i : i + length]) for i in range(len(words) - length + 1)} if words else set())
    return sets


def components(rows, size, percent=80):
    """Smallest id of each row's component, all pairs compared."""
    sets = shingle_sets(rows, size)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, left in enumerate(sets):
        for j in range(i):
            right = sets[j]
            if left and right and 100 * len(left & right) >= percent * len(left | right):
                parent[find(i)] = find(j)
    roots = [find(i) for i in range(len(rows))]
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return [(doc_id, len(s), least.get(root)) for (doc_id, _), s, root in zip(rows, sets, roots)], roots


def found(docs, size):
    rows = near_duplicates(docs, shingle=size).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


def chains(draw, groups, length):
    """Texts that drift: neighbours are near, ends are not."""
    rows, vocabulary = [], [f"w{k}" for k in range(3000)]
    for _ in range(groups):
        words = draw.choices(vocabulary, k=draw.randint(30, 90))
        for _ in range(length):
            rows.append(" ".join(words))
            words = list(words)
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size", [2, 5])
def test_edge_rows(documents, size):
    assert found(documents(EDGE_ROWS), size) == sorted(components(EDGE_ROWS, size)[0], key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_drifting_groups_by_brute_force(documents, size):
    rows = chains(random.Random(size), groups=6, length=40)
    assert found(documents(rows), size) == sorted(components(rows, size)[0], key=repr)


def test_shared_passage_links_nothing(documents):
    """Many texts with one long passage fall into common buckets and stay apart."""
    draw = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"{k}_{j}" for j in range(draw.randint(20, 60)))) for k in range(150)]
    assert found(documents(rows), 2) == sorted(components(rows, 2)[0], key=repr)


def test_documents_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(row) for row in docs.collect()]
    result = near_duplicates(docs, shingle=2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in result) == sorted(components(rows, 2)[0])
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in result)


def test_one_document_of_each_group_stays(spark, documents):
    docs = documents(EDGE_ROWS)
    kept = without_near_duplicates(docs, shingle=2)
    assert kept.columns == docs.columns
    sets = shingle_sets(EDGE_ROWS, 2)
    _, roots = components(EDGE_ROWS, 2)
    groups = {root for root, s in zip(roots, sets) if s}
    assert kept.count() == len(groups) + sum(not s for s in sets)


def test_extra_columns_stay(spark):
    rows = [(1, "a b c d e f", 5, "k"), (2, "a b c d e f", 6, "k"), (3, "g h i j", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int, node string")
    assert sorted(map(tuple, without_near_duplicates(docs).collect())) == [rows[0], rows[2]]


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []
    assert without_near_duplicates(documents([])).collect() == []


def test_registers_estimate_similarity_and_merge():
    draw = np.random.default_rng(4)
    factors = sketches.multipliers(2000)
    for shared, alone in ((800, 100), (300, 300), (50, 500)):
        values = draw.integers(0, 2**63, shared + 2 * alone, dtype=np.uint64)
        left, right = values[: shared + alone], values[alone + np.arange(shared + alone)]
        a, b = sketches.sketch(left, factors), sketches.sketch(right, factors)
        both = len(np.intersect1d(left, right))
        true = both / (len(left) + len(right) - both)
        size = np.array([float(len(left))])
        assert sketches.estimate(a[None], b[None], size, size)[0] == pytest.approx(true, abs=0.05)
        union = sketches.sketch(np.union1d(left, right), factors)
        assert (np.maximum(a, b) == union).all()


@pytest.mark.parametrize("percent", [50, 79, 101])
def test_similarities_the_bands_are_not_made_for_are_refused(documents, percent):
    docs = documents([(1, "some text")])
    for find in (near_duplicates, without_near_duplicates):
        with pytest.raises(ValueError):
            find(docs, percent=percent)


@pytest.mark.parametrize("group", [1000, 5000])
def test_alike_but_unlinked_texts_meet_in_proportion(spark, documents, monkeypatch, group):
    """One group, similar by 0.7 in all pairs: joined rows grow with its members, not with their pairs."""
    shared = [f"shared{i}" for i in range(82)]
    rows = [(i, " ".join(shared + [f"own{i}x{j}" for j in range(18)])) for i in range(group)]
    rows += [(group + 1, rows[3][1] + " more"), (group + 2, rows[group // 2][1] + " other words")]
    joined, write = {}, near.written

    def counted(df, label):
        out = write(df, label)
        joined[label] = joined.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(near, "written", counted)
    found = {r.doc_id: r.component_id for r in near_duplicates(documents(rows), shingle=1).collect()}
    assert found == {i: i for i in range(group)} | {group + 1: 3, group + 2: group // 2}
    for label in ("near-pairs", "near-likely", "near-lists", "near-met", "near-homes"):
        assert joined.get(label, 0) <= 45 * group, label
    assert joined["near-prefixes"] <= 25 * group


def test_hot_nodes_are_salted(spark, monkeypatch):
    monkeypatch.setattr(joins, "CROWD", 5)
    rows = spark.createDataFrame([(i % 3 if i < 90 else i, i) for i in range(100)], "a bigint, b bigint").persist()
    facts = spark.createDataFrame([(i, f"fact {i}") for i in range(100)], "a bigint, fact string")
    found = joins.salted_join(rows, facts, "a", "b")
    assert sorted(map(tuple, found.select("a", "b", "fact").collect())) == sorted(
        (r.a, r.b, f"fact {r.a}") for r in rows.collect()
    )
    twice = joins.joined_with_hot_keys(rows, facts, "a")
    assert sorted(map(tuple, twice.select("a", "b", "fact").collect())) == sorted(map(tuple, found.select("a", "b", "fact").collect()))


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_prefixes_of_similar_sets_meet(spark, percent):
    draw = np.random.default_rng(percent)
    sets = []
    for _ in range(40):
        base = draw.integers(0, 300, draw.integers(1, 60))
        for _ in range(3):
            sets.append(np.unique(np.where(draw.random(len(base)) < 0.06, draw.integers(0, 300, len(base)), base)))
    rows = [(bytes([i]), bytes([i]), s.astype(np.uint64).tobytes()) for i, s in enumerate(sets)]
    left = spark.createDataFrame(rows, "node binary, component binary, members binary")
    lists = {}
    for r in near._prefixes(left, percent).collect():
        lists.setdefault(r.token, {})[r.node[0]] = r.rest
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(np.intersect1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both):
                meets = [m for m in lists.values() if i in m and j in m]
                assert any((100 + percent) * (1 + min(m[i], m[j])) >= percent * (len(x) + len(y)) for m in meets)

