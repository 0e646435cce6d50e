"""Session defaults, scoped settings and scratch folders."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package wants; deployment (memory, executors) stays with spark-submit.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def build_session(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with this package's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Candle times are zone-free; pin the session zone so zoned casts cannot shift them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(df: DataFrame) -> None:
    """Refuse a session zone with clock changes, where zone-free times would not stay in order."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC, it is {zone}")


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options for a block. A streaming query copies them when it starts."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=None)
def _own_folder() -> str:
    """One temporary folder for this driver, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="wickframe-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Where that is not set, a driver without executors uses a temporary folder of its own, which it
    removes when it ends; on a cluster the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
