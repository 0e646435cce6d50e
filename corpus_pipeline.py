"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next.

All stages but the last return the columns they were given, extra ones too, whatever their names. Texts may be null,
empty or of any length and rows may be repeated; no stage drops a row for that but as it says. An empty table goes
through all stages and leaves an empty result with its columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.llm import bpe, decontaminate, language, near_duplicates, secrets
from wickframe.llm.runtime import table
from wickframe.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters (null and empty texts too) and those no learned language is likely for.

    The model learns from the labelled documents that are not held out; where there are none, all texts with
    letters stay. A score at the cut stays. Repeated rows stay or go together.
    """
    return language.with_language(docs, language.fit_on_documents(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, by five-word shingles.

    The one with the smallest id stays; of rows that share it the one with the smallest hash of its text, of rows equal
    in both any one. Texts without words all stay.
    """
    return near_duplicates.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, by windows of similarity 0.8 and more.

    Null and empty texts stay; an empty benchmark drops nothing.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts, and count characters anew.

    Spans that overlap are replaced as one; null texts stay null, with a null count. No document goes.
    """
    found = secrets.redact(docs, secrets.fit_cuts(docs))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left and decode it again: a row of digests for each document, repeated rows too.

    A null text counts as empty and has no ids.
    """
    return bpe.encode_digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

# Trained models, sketches and tokenizers are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is a table before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
