"""Folder checks and deletes on whatever file system a path lives on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _handle(spark, path)
    return fs.exists(hadoop)


def _statuses(spark: SparkSession, path: str) -> list:
    fs, hadoop = _handle(spark, path)
    return list(fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    return [s.getPath().getName() for s in _statuses(spark, path) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``."""
    return [s.getPath().getName() for s in _statuses(spark, path) if not s.isDirectory()]


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty folder as a mark."""
    fs, hadoop = _handle(spark, path)
    fs.mkdirs(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _handle(spark, path)
    fs.delete(hadoop, True)
