"""Operators 6, 7 and 9 against the tokenizers library and brute force."""

from __future__ import annotations

import json
import random
import re
import tracemalloc
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wickframe.llm import bpe, token_counts, token_files
from wickframe.llm.bpe_automaton import ByteBpe, MergeAutomaton
from wickframe.llm.chunks import Remembered
from wickframe.llm.runtime import file_bytes, tokenizer_path

from .rows import EDGE_ROWS, SF_DIR

CONTENT = file_bytes(tokenizer_path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_str(CONTENT.decode())
OWN = ByteBpe(CONTENT)
PARTS = Remembered(OWN.encode, limit=200)
FILES = token_files._parts(CONTENT)

# Pieces that meet in odd ways: white space of all kinds, marks, digits, contractions, the added token.
PIECES = (
    "a b the he th ing Ing ' 's 've 1 22 . , ... = ==== é ß 中 👍 ́ ಝ <|endoftext|> < | \x1c \x85 \xa0 　 Ġ \U000323b0"
).split(" ") + [" ", "  ", "\n", "\t", "\r\n", " \n"]


def expected(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_automaton_and_parts_encode_as_the_library(text):
    ids = expected(text)
    assert OWN.encode([text])[0] == ids
    assert [i for part in PARTS.texts([text])[0] for i in part] == ids
    assert np.frombuffer(b"".join(FILES.texts([text])[0]), "<u4").tolist() == ids
    assert OWN.decode(ids).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_as_the_library(text):
    assert OWN.encode([text])[0] == expected(text)
    assert np.frombuffer(b"".join(FILES.texts([text])[0]), "<u4").tolist() == expected(text)


@pytest.mark.parametrize("encode", [OWN.packed, FILES._encode])
def test_joined_ids_of_many_texts_are_those_of_the_library(encode):
    draw, parts = random.Random(8), Remembered(encode, limit=60, together=7)
    odd = ["", None, " ", "one", " a", "a ", "x" * 70, f"a {'y' * 70} b {'z' * 70}\t c", "don't.Stop a.\nB the*** it,it"]
    for _ in range(12):
        made = ["".join(draw.choices(PIECES, k=draw.randint(0, 40))) for _ in range(20)]
        texts = draw.sample([*odd, *made], k=draw.randint(1, 20))
        ids, ends = parts.joined(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [expected(text or "") for text in texts]
    ids, ends = parts.joined(pa.array([], pa.string()))
    assert (ids.tolist(), ends.tolist()) == ([], [0])


@pytest.mark.parametrize("encode", [OWN.packed, FILES._encode])
def test_memory_of_encoding_follows_distinct_parts(encode):
    words = [f"{first}{last}" for first in "abcdefghij" for last in ("one", "two,", "three***", "four.\nNext")]
    texts = pa.array([" ".join(random.Random(at).choices(words, k=20_000)) for at in range(20)])
    parts, given = Remembered(encode), []
    parts._encode = lambda some: given.extend(some) or encode(some)
    tracemalloc.start()
    ids, ends = parts.joined(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(given) <= 2 * len(words)
    assert peak < 12e6 + ids.nbytes  # the words of these texts as strings take 20 MB and more
    assert ids[: ends[1]].tolist() == expected(texts[0].as_py())


def test_new_words_are_encoded_many_at_a_time(monkeypatch):
    calls = []

    class Counted:
        def __init__(self, of):
            self._of = of

        def __getattr__(self, name):
            value = getattr(self._of, name)
            if name == "model":
                return Counted(value)
            if name in ("tokenize", "encode", "encode_batch", "encode_batch_fast"):
                calls.append(name)
            return value

    class Counting:
        from_str = staticmethod(lambda content: Counted(Tokenizer.from_str(content)))

    monkeypatch.setattr("tokenizers.Tokenizer", Counting)
    parts, draw = token_files._parts(CONTENT), random.Random(4)
    words = sorted({"".join(draw.choices("aehrñé", k=7)) for _ in range(8000)})
    texts = [" ".join(f"{word}{end}" for word in words) for end in ("", ",", "***")]
    ids, ends = parts.joined(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [expected(text) for text in texts]
    assert len(calls) < len(words) / 8


def test_file_parts_that_come_and_go_encode_as_the_library():
    draw, parts = random.Random(9), token_files.FileParts(CONTENT, limit=40)
    letters = "abz\u00c0\u00e0\u00ff\u00c3\u0120\u0142\u024f\u0250\u00d7\u00aa"
    odd = ["", None, " ", "one", "x" * 70, f"a {'y' * 70}. {'z' * 70}\t c", "a <|endoftext|> b<|endoftext|>", "a\xa0 b \xa0"]
    for _ in range(40):
        words = ["".join(draw.choices(letters, k=draw.randint(1, 6))) + draw.choice(PIECES) for _ in range(60)]
        made = [" ".join(draw.choices(words, k=draw.randint(1, 50))) for _ in range(6)]
        texts = draw.sample([*odd, *made], k=draw.randint(1, 10))
        ids, ends = parts.joined(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [expected(text or "") for text in texts]


def test_file_parts_of_a_model_that_merges_across_words():
    plan = json.loads(CONTENT)
    plan["model"]["vocab"]["aĠ"] = max(plan["model"]["vocab"].values()) + 1
    plan["model"]["merges"].insert(0, ["a", "Ġ"])
    content = json.dumps(plan)
    ids, _ = token_files._parts(content.encode()).joined(pa.array(["la la, casa a ba ca"]))
    assert ids.tolist() == Tokenizer.from_str(content).encode("la la, casa a ba ca", add_special_tokens=False).ids


def merged(word: str, merges: list[tuple[str, str]]) -> list[str]:
    """Merges one after the other, each from the left."""
    parts = list(word)
    for left, right in merges:
        at = 0
        while at < len(parts) - 1:
            if parts[at] == left and parts[at + 1] == right:
                parts[at : at + 2] = [left + right]
            at += 1
    return parts


def test_small_automata_against_merging():
    draw = random.Random(5)
    for _ in range(60):
        tokens, merges = list("abc"), []
        for _ in range(8):
            pair = draw.choice(tokens), draw.choice(tokens)
            if "".join(pair) not in tokens:
                tokens.append("".join(pair))
                merges.append(pair)
        automaton = MergeAutomaton({token: at for at, token in enumerate(tokens)}, merges)
        words = {"".join(draw.choices("abc", k=draw.randint(1, 14))) for _ in range(40)}
        for word, ids in automaton.encode(words).items():
            assert [tokens[i] for i in ids] == merged(word, merges)


def test_word_of_one_letter_takes_linear_time():
    assert OWN.encode(["a" * 300_000])[0] == expected("a" * 300_000)


def test_round_trip_query_on_edge_rows(documents):
    rows = bpe.encode_digests(documents(EDGE_ROWS)).collect()
    wanted = []
    for doc_id, text in EDGE_ROWS:
        ids = expected(text or "")
        digest = sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((doc_id, len(ids), digest, sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(wanted, key=repr)


def test_ids_decode_to_their_texts(documents):
    docs = documents(EDGE_ROWS)
    decoded = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    assert sorted(map(tuple, decoded), key=repr) == sorted(((i, t or "") for i, t in EDGE_ROWS), key=repr)


def test_bytes_that_are_no_text_are_replaced(spark):
    part = LIBRARY.encode("👍", add_special_tokens=False).ids[:1]
    rows = spark.createDataFrame([(1, part), (2, None)], "doc_id bigint, ids array<int>")
    found = dict(map(tuple, bpe.decode_ids(rows).collect()))
    assert found == {1: LIBRARY.decode(part, skip_special_tokens=False), 2: ""}


@pytest.mark.parametrize("operator", [bpe.encode_digests, bpe.encode_texts, token_counts.count_tokens])
def test_empty_table(documents, operator):
    assert operator(documents([])).collect() == []


def test_token_files(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents(EDGE_ROWS), path)
    found = token_files.digests(token_files.read_token_files(spark, path)).orderBy("start").collect()
    lengths = [row["n_tokens"] for row in found]
    assert [row["start"] for row in found] == [sum(lengths[:at]) for at in range(len(found))]
    assert [row["doc_id"] for row in found] == sorted((i for i, _ in EDGE_ROWS), key=lambda i: (i is not None, i))
    wanted = [(i, [*expected(t or ""), 2]) for i, t in EDGE_ROWS]
    crcs = [(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in wanted]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=repr) == sorted(crcs, key=repr)
    looked_up = token_files.find_documents(spark, path, [8])
    assert [row["ids"] for row in looked_up.collect()] == [[*expected("word " * 30_000), 2]]
    assert "PushedFilters: [In(doc_id, [8])]" in looked_up._jdf.queryExecution().toString() or "EqualTo(doc_id,8)" in (
        looked_up._jdf.queryExecution().toString()
    )


def test_empty_token_files(spark, documents, tmp_path):
    token_files.write_token_files(documents([]), str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).collect() == []


def greedy(word: bytes, first: set[bytes], inner: set[bytes]) -> int:
    count, at = 0, 0
    while at < len(word):
        pieces = first if at == 0 else inner
        end = next((end for end in range(len(word), at, -1) if word[at:end] in pieces), None)
        if end is None:
            return 1
        count, at = count + 1, end
    return count


def test_longest_match_automata_against_greedy():
    draw = random.Random(3)
    for _ in range(80):
        make = lambda: bytes(draw.choices(b"abc", k=draw.randint(1, 5)))
        first = {make() for _ in range(6)} | ({b"a", b"b"} if draw.random() < 0.7 else set())
        inner = {make() for _ in range(6)} | ({b"a", b"b", b"c"} if draw.random() < 0.7 else set())
        counter = token_counts.PieceCounter(first, inner)
        for _ in range(60):
            word = bytes(draw.choices(b"abc", k=draw.randint(1, 12)))
            assert counter.count(word) == greedy(word, first, inner), (word, first, inner)


def test_token_counts_on_documents(spark, documents):
    first, inner = token_counts.read_vocabulary(CONTENT)
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).select("doc_id", "text").collect()
    rows = [*map(tuple, texts), *((i, t) for i, t in EDGE_ROWS if i != 7)]
    found = token_counts.count_tokens(documents(rows)).collect()
    wanted = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        wanted.append((doc_id, len(words), sum(greedy(f" {w}".encode(), first, inner) for w in words)))
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_the_file_has_the_parts_the_automaton_needs():
    plan = json.loads(CONTENT)
    assert plan["normalizer"] is None and plan["pre_tokenizer"]["type"] == "ByteLevel"
    assert len(OWN.automaton.labels) == len(plan["model"]["vocab"])
