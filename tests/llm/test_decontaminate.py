"""Operator 10 against all windows by brute force."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from wickframe.llm import decontaminate
from wickframe.llm.decontaminate import (
    Benchmark,
    find_leaks,
    near_blocks,
    shingles,
    similarity,
    without_leaks,
    words_of,
)

from .rows import EDGE_ROWS, SF_DIR

ITEMS = "item_id bigint, text string"


def brute_force(rows, items):
    """Items with a window of their size, or the whole of a shorter text, of similarity 0.8."""
    wanted = []
    indexed = [(item, words_of(text)) for item, text in items]
    for doc_id, text in rows:
        words, leaks, best = words_of(text), [], 0.0
        for item, target in indexed:
            size = min(len(target), len(words))
            windows = range(len(words) - size + 1)
            if len(target) >= 5:
                top = max((similarity(shingles(words[i : i + size]), shingles(target)) for i in windows), default=0.0)
            else:  # one shingle, the whole item
                top = float(bool(target) and any(words[i : i + size] == target for i in windows))
            if top >= 0.8:
                leaks.append(item)
                best = max(best, top)
        wanted.append((doc_id, not leaks, len(leaks), sorted(i for i in leaks if i is not None), best))
    return sorted(wanted, key=repr)


def found(docs, items, **options):
    rows = find_leaks(docs, items, **options).collect()
    return sorted(((r[0], r[1], r[2], list(r[3]), r[4]) for r in rows), key=repr)


def planted(draw):
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(6, 60)))) for k in range(25)]
    rows = []
    for doc_id in range(120):
        words = draw.choices(vocabulary, k=draw.randint(0, 150))
        if draw.random() < 0.7:
            leak = draw.choice(items)[1].upper().split()
            for _ in range(draw.choice((0, 0, 1, 2, 4))):
                leak[draw.randrange(len(leak))] = draw.choice(vocabulary)
            at = draw.randint(0, len(words))
            words[at:at] = [f"{word}," for word in leak]
        rows.append((doc_id, " ".join(words)))
    return rows, items


@pytest.mark.parametrize("block_words", [2_000_000, 100])
def test_planted_items_by_brute_force(spark, documents, block_words):
    rows, items = planted(random.Random(2))
    assert found(documents(rows), spark.createDataFrame(items, ITEMS), block_words=block_words) == brute_force(rows, items)


def test_edge_rows(spark, documents):
    items = [(1, None), (2, ""), (3, "one"), (4, EDGE_ROWS[4][1]), (4, EDGE_ROWS[4][1]), (None, "word word word word word word")]
    once = [items[0], items[1], items[2], items[3], items[5]]  # equal items count once
    assert found(documents(EDGE_ROWS), spark.createDataFrame(items, ITEMS)) == brute_force(EDGE_ROWS, once)


def test_documents_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    wanted = brute_force([tuple(r) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(docs, items) == wanted
    assert not all(row[1] for row in wanted)


def test_filter_keeps_columns_and_clean_rows(spark):
    rows = [(1, "x", None), (2, "a b c d e f g h", "clash"), (3, None, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_ids string")
    items = spark.createDataFrame([(1, "b c d e f g")], ITEMS)
    assert sorted(map(tuple, without_leaks(docs, items).collect())) == [rows[0], rows[2]]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert found(documents([]), none) == []
    assert all(row[1] for row in found(documents(EDGE_ROWS), none))


def test_short_items_are_found_whole(spark, documents):
    items = [(1, "one"), (2, "two words"), (3, "three little words"), (4, "a b c d"), (5, "..."), (6, "b c")]
    rows = [(1, "One!"), (2, "no two words, here"), (3, "words two"), (4, "x a b c d e"), (5, "three little"), (6, "two"), (7, None)]
    assert found(documents(rows), spark.createDataFrame(items, ITEMS)) == brute_force(rows, items)


@pytest.mark.parametrize("block_words", [2_000_000, 60])
def test_filter_in_one_block_and_in_many(spark, documents, block_words):
    rows, items = planted(random.Random(6))
    items_table = spark.createDataFrame(items, ITEMS)
    left = without_leaks(documents(rows), items_table, block_words=block_words).collect()
    assert sorted(r["doc_id"] for r in left) == sorted(r[0] for r in brute_force(rows, items) if r[1])


def test_hardly_any_item_is_a_candidate():
    """A hundred thousand items of one size: the blocks leave under one in a hundred, and all within the radius."""
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 63, (100_000, 4), np.uint64) * np.uint64(2) + draw.integers(0, 2, (100_000, 4), np.uint64)
    windows = draw.integers(0, 1 << 63, (30, 4), np.uint64)
    for at in range(10):  # near ones, at the radius
        bits = draw.choice(256, decontaminate.RADIUS, replace=False)
        flipped = np.zeros(256, np.uint8)
        flipped[bits] = 1
        windows[at] = prints[at] ^ np.packbits(flipped, bitorder="little").view("<u8")
    window, item = near_blocks(prints, windows)
    assert {(at, at) for at in range(10)} <= set(zip(window.tolist(), item.tolist()))
    assert len(window) < 0.01 * len(windows) * len(prints)


def test_texts_give_fingerprints_that_tell_items_apart():
    """Items of common words: unrelated windows are no candidates, and windows of similarity 0.8 nearly all are."""
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(draw.choices(vocabulary, k=40))) for k in range(1500)]
    index = Benchmark(items)
    prints = index._prints[40]
    window, item = near_blocks(prints, prints[:200])
    assert (window != item).sum() < 0.01 * 200 * 1500
    lost = tried = 0
    for place, (_, text) in enumerate(items):
        words = text.split()
        words[draw.choice((0, 1, 38, 39))] = "other"
        words[0] = draw.choice(vocabulary)
        if similarity(shingles(words), shingles(text.split())) >= 0.8:
            tried += 1
            lost += index.leaks(" ".join(words)).get(place, 0) < 0.8
    assert tried > 1000 and lost <= 1


def test_long_texts_take_bounded_memory():
    """Windows of a text that holds items everywhere are compared in parts."""
    draw = random.Random(9)
    item = draw.choices([f"w{k}" for k in range(50)], k=40)
    index = Benchmark([(1, " ".join(item))])
    peaks = []
    for times in (250, 2500):
        words = (item + draw.choices([f"w{k}" for k in range(50)], k=10)) * times
        text = " ".join(words)
        tracemalloc.start()
        assert index.leaks(text) == {0: 1.0}
        peaks.append(tracemalloc.get_traced_memory()[1] - 30 * len(words) * 8)
        tracemalloc.stop()
    assert peaks[1] < 60e6


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "b c d e f g", 5, 6, "x")], "doc_id bigint, text string, row bigint, id bigint, n_items string")
    items = spark.createDataFrame([(1, "b c d e f g"), (2, "h i j k l m n")], ITEMS)
    for block_words in (100, 7):
        assert found(docs, items, block_words=block_words) == [(1, False, 1, [1], 1.0)]
        assert without_leaks(docs, items, block_words=block_words).collect() == []
        assert without_leaks(docs, items.where("item_id = 2"), block_words=block_words).columns == docs.columns
