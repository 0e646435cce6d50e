"""The pipeline against its stages by brute force on a small table."""

from __future__ import annotations

from hashlib import sha256

import corpus_pipeline
from tokenizers import Tokenizer
from wickframe.llm import language, secrets
from wickframe.llm.decontaminate import shingles, similarity, words_of
from wickframe.llm.runtime import tokenizer_path

from .rows import EDGE_ROWS, SF_DIR
from .test_near_duplicates import components, shingle_sets


def table(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    return docs


def test_whole_pipeline_by_brute_force(spark, tmp_path):
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 260")
    rows = [tuple(r) for r in source.collect()]
    rows += [(900, None, "en", "s", None), (901, "12 34", "en", "s", 5), rows[7], (902, rows[9][1], "en", "s", 1)]
    docs = table(spark, tmp_path, rows)

    model = language.fit_on_documents(docs)
    left = [r for r in rows if model.predict(r[1])[1] >= 0.35]
    pairs = [(r[0], r[1]) for r in left]
    _, roots = components(pairs, 5)
    first: dict[int, tuple] = {}
    for row, root, members in zip(left, roots, shingle_sets(pairs, 5)):
        if members and (root not in first or row[0] < first[root][0]):
            first[root] = row
    left = list(first.values())
    items = [shingles(words_of(r["text"])) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]

    def leaks(text):
        words = words_of(text)
        for item in items:
            size = min(item.total() + 4, len(words))
            if any(similarity(shingles(words[i : i + size]), item) >= 0.8 for i in range(len(words) - size + 1)):
                return True
        return False

    left = [r for r in left if not leaks(r[1])]
    kept = spark.createDataFrame(left, docs.schema)
    cuts = secrets.fit_cuts(kept)
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    wanted = []
    for row in left:
        text = secrets._without(row[1], secrets.find(row[1], cuts), "[secret]")
        ids = library.encode(text, add_special_tokens=False).ids
        wanted.append((row[0], len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest()))
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert 0 < len(wanted) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 40").collect()]
    docs = table(spark, tmp_path, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_documents(spark, tmp_path):
    table(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_and_clashing_columns_through_all_stages(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like those the stages use inside."""
    clean = [r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60").collect() if r.lang and r.text]
    long = " ".join(f"{word}{k % 7}" for k, word in enumerate((clean[0].text + " ").split() * 400))
    rows = [(r.doc_id, r.text, r.lang) for r in clean] + [(i, text, None) for i, text in EDGE_ROWS]
    rows += [(500, long, "en"), (501, clean[1].text, "en"), (501, clean[1].text, "en"), (502, None, None), (503, "", None)]
    names = ["id", "node", "key", "row", "c0", "keep0", "similarity", "text_hash", "component", "score"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names)
    filled = [(*row, "s", None if row[1] is None else len(row[1]), *names) for row in rows]
    spark.createDataFrame(filled, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if at < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == [tuple(column.split(" ")) for column in schema.split(", ")]
            assert all([r[n] for n in names] == names for r in docs.collect())
    kept = [r["doc_id"] for r in docs.collect()]
    # One row of the text that three rows have, and of the clean ones at most near copies and leaks went.
    assert kept.count(501) == 0 and kept.count(clean[1].doc_id) <= 1
    assert len(set(kept) & {r.doc_id for r in clean}) >= 0.8 * len({r.doc_id for r in clean})
    assert 502 not in kept and 503 not in kept
