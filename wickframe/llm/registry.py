"""The queries of this package: one for each operator, over whole tables, and the pipeline's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wickframe.llm import (
    bpe,
    centroids,
    decontaminate,
    language,
    near_duplicates,
    quality,
    secrets,
    simhash,
    substrings,
    token_counts,
    token_files,
    urls,
    whitening,
)
from wickframe.llm.runtime import table
from wickframe.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(quality.RESULT)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit_on_documents(docs)
    found = language.predict(docs, model, keep=("doc_id",))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digests(secrets.scan(docs, secrets.fit_cuts(docs)))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.digests(token_files.read_token_files(spark, path))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_words(table(spark, sf_dir, "documents"))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digests(centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_secret_scans": op3_secret_scans,
    "op4_url_filters": op4_url_filters,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_centroids": op12_centroids,
    "op13_simhash": op13_simhash,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": quality.SQL,
    "op4_url_filters": urls.SQL,
}
