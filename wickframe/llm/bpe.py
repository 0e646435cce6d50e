"""Operator 9: encode and decode texts with a byte-level BPE tokenizer compiled to an automaton."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.bpe_automaton import ByteBpe
from wickframe.llm.chunks import Remembered
from wickframe.llm.runtime import Batches, file_bytes, kept, map_batches, slices, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
# New parts that are encoded at a time, and parts that a worker remembers before it lets unused ones go.
TOGETHER = 1 << 14
REMEMBERED = 300_000


def _parts(content: bytes) -> tuple[Remembered, pa.Array, pa.Array]:
    """The memory of parts, and by id how it is written, with a comma, and its label."""
    bpe = ByteBpe(content)
    ids = range(max(bpe.labels) + 1)
    numbers = pa.array([f"{i},".encode() for i in ids], pa.large_binary())
    return Remembered(bpe.packed, REMEMBERED, TOGETHER), numbers, pa.array(map(bpe.labels.get, ids), pa.large_binary())


def _spelled(ids: np.ndarray, ends: np.ndarray, table: pa.Array) -> tuple[memoryview, list[int]]:
    """The entries of all ids one after the other, and where those of each text end, from 0 on."""
    taken = table.take(pa.array(ids))
    stops = np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1)
    return memoryview(taken.buffers()[2] or b""), stops[ends].tolist()


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``(id, ids array<int>)`` for each row of ``docs``; a null text counts as empty.

    Empty texts have an empty array. Rows with equal or null ids stay apart, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(path or tokenizer_path(TOKENIZER)))

    def run(batches: Batches) -> Batches:
        parts = Remembered(ByteBpe(shared.value).packed, together=TOGETHER)
        for whole in batches:
            for batch in slices(whole, "text"):
                found, ends = parts.joined(batch.column("text"))
                values = pa.array(found.view(np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "id bigint, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``(id, text)``: the labels of the ids' arcs joined; bytes that are no UTF-8 become U+FFFD.

    Null ids give an empty text. An id the vocabulary lacks fails the job: it is not data of this
    tokenizer.
    """
    shared = rows.sparkSession.sparkContext.broadcast(file_bytes(path or tokenizer_path(TOKENIZER)))

    def run(batches: Batches) -> Batches:
        bpe = ByteBpe(shared.value)
        for batch in batches:
            texts = [
                bpe.decode(ids or []).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    cut = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_batches(cut, run, "id bigint, text string").withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Round trip of each text in one pass: number of ids, digest of the ids, digest of the decoded text.

    Returns ``(id, n_tokens, ids_sha256, decoded_sha256)`` for each row; a null text counts as empty
    (no ids, digests of nothing). The ids are hashed as decimals joined by commas. Repeated rows and rows with equal or
    null ids have a result each; other columns play no part, whatever their names. No shuffle; memory is bounded by the
    part memory and by about 8 MB of text, or one text, at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(path or tokenizer_path(TOKENIZER)))

    def run(batches: Batches) -> Batches:
        parts, numbers, labels = kept(("bpe", shared.value), lambda: _parts(shared.value))
        for whole in batches:
            for batch in slices(whole, "text"):
                found, ends = parts.joined(batch.column("text"))
                counts = np.diff(ends)
                spelled, stops = _spelled(found, ends, numbers)
                # The last comma of a text is none of its own.
                ids = [sha256(spelled[a : max(a, b - 1)]).hexdigest() for a, b in zip(stops, stops[1:])]
                spelled, stops = _spelled(found, ends, labels)
                texts = (str(spelled[a:b], "utf-8", "replace") for a, b in zip(stops, stops[1:]))
                decoded = [sha256(text.encode()).hexdigest() for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, run, schema, keeps=True).withColumnRenamed("id", id_col)
