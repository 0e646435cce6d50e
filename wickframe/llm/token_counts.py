"""Operator 7: number of greedy longest-match pieces of each word, by a linear automaton.

The trie of the vocabulary has two roots, for pieces that begin a word and for pieces inside one. Each
node has a failure link, the node to go on from once the pieces it stands for are popped, and the
number of pieces popped on the way; both are computed once. A word is read byte by byte, each byte once,
and the numbers are summed: no piece is ever built.
"""

from __future__ import annotations

import json
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.bpe_automaton import byte_alphabet
from wickframe.llm.runtime import WORD, Batches, file_bytes, kept, map_batches, slices, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
_words = re.compile(WORD)
_START, _INSIDE, _NONE = 0, 1, -1


class PieceCounter:
    """``first`` pieces may begin a word, ``inner`` pieces may follow; both as bytes."""

    def __init__(self, first: set[bytes], inner: set[bytes]):
        self._goto: dict[int, int] = {}
        ends: set[int] = set()
        nodes = 2
        for root, pieces in ((_START, first), (_INSIDE, inner)):
            for piece in pieces:
                at = root
                for byte in piece:
                    key = at << 8 | byte
                    at = self._goto.get(key, _NONE)
                    if at < 0:
                        at = self._goto[key] = nodes
                        nodes += 1
                if piece:
                    ends.add(at)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in self._goto.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        self._fail, self._popped = [_NONE] * nodes, [0] * nodes
        waiting = deque((_START, _INSIDE))
        while waiting:
            parent = waiting.popleft()
            for byte, node in children.get(parent, ()):
                waiting.append(node)
                if node in ends:
                    self._fail[node], self._popped[node] = _INSIDE, 1
                    continue
                link, popped = self._fail[parent], self._popped[parent]
                while link != _NONE and (link << 8 | byte) not in self._goto:
                    popped += self._popped[link]
                    link = self._fail[link]
                if link != _NONE:
                    self._fail[node], self._popped[node] = self._goto[link << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of the word; one, the unknown piece, where the vocabulary cannot spell it."""
        goto, fail, popped = self._goto, self._fail, self._popped
        at, pieces = _START, 0
        for byte in word:
            while (key := at << 8 | byte) not in goto:
                if fail[at] == _NONE:
                    return 1
                pieces += popped[at]
                at = fail[at]
            at = goto[key]
        while at > _INSIDE:
            if fail[at] == _NONE:
                return 1
            pieces += popped[at]
            at = fail[at]
        return pieces


def read_vocabulary(content: bytes) -> tuple[set[bytes], set[bytes]]:
    """First and inner pieces of a byte-level vocabulary file: those with a leading blank begin words."""
    bytes_of = byte_alphabet()
    pieces = [
        bytes(bytes_of[c] for c in text)
        for text in json.loads(content)["model"]["vocab"]
        if all(c in bytes_of for c in text)
    ]
    return (
        {p for p in pieces if p[:1] == b" " and b" " not in p[1:]},
        {p for p in pieces if b" " not in p},
    )


def _counter(content: bytes) -> tuple[PieceCounter, dict[str, int]]:
    return PieceCounter(*read_vocabulary(content)), {}


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(id, n_words, n_tokens)`` for each row: words of the whole text and their pieces in all.

    Each word is read with one blank before it. A null, empty or blank text has no words and no tokens.
    Counts of distinct words are remembered, at most half a million at a time, none over 64 characters. Repeated rows
    and rows with equal or null ids have a result each; other columns play no part, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(path or tokenizer_path(VOCABULARY)))

    def run(batches: Batches) -> Batches:
        counter, known = kept(("pieces", shared.value), lambda: _counter(shared.value))
        for whole in batches:
            for batch in slices(whole, "text"):
                n_words, n_tokens = [], []
                for text in batch.column("text").to_pylist():
                    words = _words.findall(text or "")
                    counts = list(map(known.get, words))
                    if None in counts:
                        if len(known) > 500_000:
                            known.clear()
                        for at, word in enumerate(words):
                            if counts[at] is None:
                                counts[at] = counter.count(f" {word}".encode())
                                if len(word) <= 64:
                                    known[word] = counts[at]
                    n_words.append(len(words))
                    n_tokens.append(sum(counts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                    ["id", "n_words", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "id bigint, n_words bigint, n_tokens bigint", keeps=True).withColumnRenamed("id", id_col)
