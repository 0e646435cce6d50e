"""Operator 6: token ids of documents in ORC files, ordered by document id.

Ids lie in ORC's run-length encoded integer streams. Each file holds a range of document ids in
ascending order, so file, stripe and row-group statistics prune lookups; Bloom filters on the document
id serve those inside the range of a row group that does not hold them. Readers split files by stripes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickframe.llm.bpe_automaton import byte_alphabet
from wickframe.llm.chunks import LONGEST_KEPT, Remembered
from wickframe.llm.runtime import Batches, file_bytes, kept, map_batches, slices, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

# Row groups of 1,000 documents keep lookups small; the values of the ids column dwarf the index.
ORC_OPTIONS = {
    "compression": "lz4",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

# Letters, in every version of Unicode, and what follows them, from a character that is none.
_WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ɏ]+)(?P<rest>(?:[\x00-@\[-`{-\x7f](?s:.*))?)$"

_ASCII = (*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1))

# Parts and ends of parts that are kept, about; bytes of text that are cut at a time, what a task mostly has.
REMEMBERED, RESTS, AT_A_TIME = 500_000, 1 << 17, 20 << 20

# Parts that are encoded as one text; words that the model gets at once, and those that are cut apart together.
ONE_TEXT, WORDS, TOGETHER = 250, 16, 1 << 14

_ROWS = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"


class FileParts(Remembered):
    """Ids of parts as bytes; new parts are put together from a word of letters, kept as a part too, and what follows.

    Letters behind a blank are one pre-token, and what follows them is encoded as it is on its own. The library encodes
    new words many at a time, and Arrow puts the parts together, so the work follows the distinct words.
    """

    def __init__(self, content: bytes, limit: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        model = tokenizer.model
        self._tokenizer, self._model = tokenizer, model
        self._starts = np.array([tokenizer.id_to_token(i)[0] == "Ġ" for i in range(tokenizer.get_vocab_size())])
        self._shown = np.zeros(256, "<u4")
        for c, byte in byte_alphabet().items():
            self._shown[byte] = ord(c)
        # Bytes of words and blanks. Where no token of these alone has a blank after a word's byte, words that follow
        # each other merge as each does by itself.
        alphabet = {chr(c) for c in self._shown[[0x20, *_ASCII, *range(0x80, 0xC0), *range(0xC3, 0xCA)]]}
        by_place = model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix or model.fuse_unk
        self._apart = not by_place and not any(
            "Ġ" in token.lstrip("Ġ") and alphabet.issuperset(token) for token in tokenizer.get_vocab()
        )
        self._rests: dict[str, bytes] = {}
        super().__init__(self._some, limit)
        self._letter = len(self._one(" a"))

    def _ids(self, parts: list[str]) -> list[int]:
        return self._tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids

    def _some(self, parts: list[str]) -> list[bytes]:
        """Ids of one part of any kind, or of parts that each begin with a blank."""
        ids = self._ids(parts)
        return [np.array(ids, "<u4").tobytes()] if len(parts) == 1 else self._cut(ids, len(parts)).to_pylist()

    def _cut(self, found: list[int], count: int) -> pa.Array:
        """Ids of parts one after the other, apart: only the blank that begins a part makes a token with Ġ."""
        ids = np.array(found, "<u4")
        at = np.flatnonzero(self._starts[ids])
        if len(at) != count:
            raise ValueError("a part has more than one beginning")
        ends = np.append(at, len(ids)) * 4
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(ends), pa.py_buffer(ids)])

    def _parts_ids(self, names: list[str]) -> pa.Array:
        """Ids of parts, with a blank before each."""
        some = ([f" {name}" for name in names[at : at + ONE_TEXT]] for at in range(0, len(names), ONE_TEXT))
        return _all(self._cut(self._ids(each), len(each)) for each in some)

    def _word_ids(self, words: list[str]) -> pa.Array:
        """Ids of words of letters, with a blank before each: a word is one pre-token, so the model needs no pattern."""
        found, count = [], WORDS if self._apart else 1
        for start in range(0, len(words), TOGETHER):
            text = "".join([f" {word}" for word in words[start : start + TOGETHER]]).encode()
            some = self._shown[np.frombuffer(text, np.uint8)].tobytes().decode("utf-32-le").split("Ġ")[1:]
            texts = ("Ġ" + "Ġ".join(some[at : at + count]) for at in range(0, len(some), count))
            found.append(self._cut([token.id for text in texts for token in self._model.tokenize(text)], len(some)))
        return _all(found)

    def _rest_ids(self, rests: list[str]) -> pa.Array:
        """Ids of what follows letters: those of a part with one letter before it, less the letter's."""
        if len(self._rests) > RESTS:
            self._rests.clear()
        new = [rest for rest in rests if rest not in self._rests]
        found = self._parts_ids([f"a{rest}" for rest in new]).to_pylist()
        self._rests.update(zip(new, (ids[self._letter :] for ids in found)))
        return pa.array([self._rests[rest] for rest in rests], pa.large_binary())

    def _numbered(self, parts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """As of any parts, by arrays: first the new words, then the parts that end otherwise, then those without words."""
        self._forget()
        cut = pc.extract_regex(parts, _WORD)
        has_word = _mask(cut.is_valid())
        coded = cut.field(0).filter(cut.is_valid()).dictionary_encode()
        words, word_of = coded.dictionary, np.zeros(len(parts), np.int64)
        word_of[has_word] = coded.indices.to_numpy()
        found = self._kept(pa.concat_arrays([parts, words]))
        numbers, of_words = found[: len(parts)], found[len(parts) :]

        sizes = pc.utf8_length(parts)
        missing = (numbers < 0) & _mask(pc.and_(pc.greater(sizes, 0), pc.equal(pc.utf8_trim_whitespace(parts), parts)))
        short = _mask(pc.less_equal(sizes, LONGEST_KEPT))
        new = missing & short
        needed = np.zeros(len(words), bool)
        needed[word_of[new & has_word]] = True
        self._used[numbers[numbers >= 0]] = True
        self._used[of_words[needed & (of_words >= 0)]] = True

        unknown = np.flatnonzero(needed & (of_words < 0))
        names = words.take(pa.array(unknown))
        of_words[unknown] = self._add(names, self._word_ids(_strings(names)))
        alone = _mask(pc.equal(pc.binary_length(cut.field(1)), 0).fill_null(False))
        at = new & has_word & alone
        numbers[at] = of_words[word_of[at]]

        at = np.flatnonzero(new & has_word & ~alone)
        if len(at):
            rests = cut.field(1).take(pa.array(at)).dictionary_encode()
            ends = self._rest_ids(_strings(rests.dictionary)).take(rests.indices)
            firsts = self._values.take(pa.array(of_words[word_of[at]]))
            values = pc.binary_join_element_wise(firsts, ends, pa.scalar(b"", pa.large_binary()))
            numbers[at] = self._add(parts.take(pa.array(at)), values)
        at = np.flatnonzero(new & ~has_word)
        names = parts.take(pa.array(at))
        numbers[at] = self._add(names, self._parts_ids(_strings(names)))

        at = np.flatnonzero(missing & ~short)
        if not len(at):
            return self._values, numbers
        numbers[at] = np.arange(len(self._values), len(self._values) + len(at))
        long = [self._one(f" {name}") for name in _strings(parts.take(pa.array(at)))]
        return _all([self._values, pa.array(long, pa.large_binary())]), numbers

    def _add(self, names: pa.Array, values: pa.Array) -> np.ndarray:
        """Keep more parts; returns where."""
        start = len(self._parts)
        self._parts, self._values = pa.concat_arrays([self._parts, names]), _all([self._values, values])
        self._used = np.concatenate([self._used, np.ones(len(names), bool)])
        return np.arange(start, len(self._parts))


def _parts(content: bytes) -> Remembered:
    return FileParts(content)


def _all(arrays: Iterable[pa.Array]) -> pa.Array:
    return pa.concat_arrays([pa.array([], pa.large_binary()), *arrays])


def _mask(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int | None = END_ID,
) -> None:
    """Encode each text, append ``end_id`` and write ORC files in ascending id order below ``path``.

    A null text counts as empty, so its document is the end id alone. Null ids come first; rows of one
    id follow a hash of their text, then the text, so that repeated runs write the same files. Other
    columns are ignored. Texts are dealt by id ranges before they are encoded, once; nothing larger
    than a batch is held.
    """
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer or tokenizer_path(TOKENIZER)))

    def run(batches: Batches) -> Batches:
        parts = kept(("ids", shared.value), lambda: _parts(shared.value))
        part, start = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text", AT_A_TIME):
                ids, offsets = parts.joined(batch.column("text"))
                if end_id is not None:
                    ids, offsets = np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
                lengths = np.diff(offsets)
                values = pa.array(ids.view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(np.full(len(lengths), part, np.int32)),
                        pa.array(start + offsets[:-1]),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                    ],
                    ["doc_id", "part", "local_start", "n_tokens", "ids"],
                )
                start += int(offsets[-1])

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = ("doc_id", F.xxhash64("text"), "text")
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    map_batches(dealt, run, _ROWS, keeps=True).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``; ``start`` counts the ids of all documents before this one.

    Each row knows its start within its file. The starts of the files come from their sums, one row
    for each task that wrote, which is what is broadcast: at most ``spark.sql.shuffle.partitions`` rows.
    """
    rows = spark.read.schema(_ROWS).orc(path)
    sums = rows.groupBy("part").agg(F.sum("n_tokens").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def find_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of a few documents; statistics and Bloom filters skip the stripes and row groups without them."""
    return spark.read.schema(_ROWS).orc(path).where(F.col("doc_id").isin(ids)).select("doc_id", "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``: CRC-32 of the ids as little-endian 32-bit integers."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy().astype("<i4", copy=False)
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return map_batches(rows, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
