"""What the operators share: reading tables, scratch tables, Arrow maps, code and file shipping."""

from __future__ import annotations

import atexit
import ctypes
import os
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path
from shutil import rmtree
from tempfile import mkdtemp
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wickframe.session import scratch_dir

ROOT = Path(__file__).resolve().parents[2]
PACKAGE = Path(__file__).resolve().parents[1].name

# Words of a text: runs of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut there, and lost executors lose none of it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it on their path.

    Workers on this machine have the driver's path. Others have it only where the cluster says so.
    """
    local = spark.sparkContext.master.startswith("local")
    path = os.environ.get("PYTHONPATH", "") if local else spark.conf.get("spark.executorEnv.PYTHONPATH", "")
    if str(ROOT) in path.split(os.pathsep):
        return
    done = spark.conf.get("spark.wickframe.shipped", None)
    if done == spark.sparkContext.applicationId:
        return
    folder = mkdtemp(prefix="ship-")  # Spark sends the file from here; it is no data
    atexit.register(rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{PACKAGE}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((ROOT / PACKAGE).rglob("*.py")):
            out.write(path, path.relative_to(ROOT))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.wickframe.shipped", spark.sparkContext.applicationId)


_kept: dict[Any, Any] = {}


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task: one thing at a time, so that operators do not add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def release() -> None:
    """Let go of what the worker keeps."""
    if _kept:
        _kept.clear()


@lru_cache(maxsize=1)
def _trimmer() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def trim() -> None:
    """Give memory that is free back to the machine; a worker that goes on with other work would hold it."""
    pa.default_memory_pool().release_unused()
    give_back = _trimmer()
    if give_back:
        give_back(0)


def map_batches(
    df: DataFrame, function: Callable[[Batches], Batches], schema: str | T.StructType, keeps: bool = False
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers.

    A function that does not keep anything lets go of what the worker kept for another. Memory that is free when a task
    begins or ends goes back to the machine, also while the worker waits.
    """
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        if not keeps:
            release()
        trim()
        yield from function(batches)
        trim()

    return df.mapInArrow(run, schema)


@lru_cache(maxsize=8)
def file_bytes(path: str) -> bytes:
    return Path(path).read_bytes()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose text column has about ``most`` bytes, so that memory does not follow long rows."""
    start, size = 0, 0
    for at, length in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if size > most:
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += length or 0
    if start < batch.num_rows:
        yield batch.slice(start)
