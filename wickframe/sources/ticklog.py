"""The keyed message log as a DataFrame: a Kafka topic, or files of the same shape."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.schemas import LOG_ROW

# What the gate says of a row, and the folders it keeps rows in.
PASSED = "passed"
GATE = "gate"
REJECTS = f"{GATE}=rejected"
DAY = "day"
LOG_FOLDERS = (GATE, DAY)


@dataclass(frozen=True)
class FileLog:
    """Log rows in Parquet or JSON files below one folder."""

    path: str
    format: str = "parquet"
    # Streaming reads only: how much one micro-batch takes, and whether new files go first.
    max_files_per_trigger: int | None = None
    latest_first: bool = False
    # Whether to leave out what the gate turned away. Its writer says so in each row (``passed``), so a
    # reader need not know before there is a file; logs without that column have no rejects.
    gated: bool = True
    # Messages from one time on, and before another: see :func:`between`.
    since: datetime | None = None
    until: datetime | None = None


@dataclass(frozen=True)
class KafkaLog:
    """A topic, read through Spark's Kafka connector (add it with ``--packages``)."""

    servers: tuple[str, ...]
    topic: str
    # A new query starts here; "latest" skips history. A restart always resumes its checkpoint.
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    # Splits partitions further, so that one hot partition is not one task.
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    # Messages from one time on, and before another, in UTC: see :func:`between`.
    since: datetime | None = None
    until: datetime | None = None


LogSource = FileLog | KafkaLog


def kafka_options(source: KafkaLog, streaming: bool) -> dict[str, str]:
    """Reader options for a topic."""
    options = {
        "kafka.bootstrap.servers": ",".join(source.servers),
        "subscribe": source.topic,
        "startingOffsets": source.starting_offsets,
    }
    if source.min_partitions:
        options["minPartitions"] = str(source.min_partitions)
    if not streaming:
        options["endingOffsets"] = source.ending_offsets
    elif source.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(source.max_offsets_per_trigger)
    if source.since is not None:
        # Times win over offsets in the connector. A partition without a message that late starts at its end.
        options["startingTimestamp"] = str(_epoch_millis(source.since))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if source.until is not None and not streaming:
        options["endingTimestamp"] = str(_epoch_millis(source.until))
    options |= dict(source.options)
    if "assign" in options:  # the connector takes one way to choose partitions
        del options["subscribe"]
    return options


def read_log(spark: SparkSession, source: LogSource, *, streaming: bool = False) -> DataFrame:
    """Log rows ``(key, value, partition, offset, timestamp)``, key and value as text."""
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, KafkaLog):
        rows = reader.format("kafka").options(**kafka_options(source, streaming)).load()
    else:
        # All files below the folder, by one schema: nothing is concluded from folders that are there when
        # a stream is set up, since the first batch of a log may come later.
        schema = T.StructType([*LOG_ROW, T.StructField(PASSED, T.BooleanType())])
        reader = reader.format(source.format).schema(schema).option("recursiveFileLookup", "true")
        if streaming:
            reader = reader.option("latestFirst", str(source.latest_first).lower())
            if source.max_files_per_trigger:
                reader = reader.option("maxFilesPerTrigger", source.max_files_per_trigger)
        rows = reader.load(source.path)
        if source.gated:
            rows = rows.filter(_is_message())
        if source.since is not None or source.until is not None:
            rows = rows.filter(_days_between(source.since, source.until))
    return _timed(log_rows(rows), source.since, source.until)


def between(source: LogSource, since: datetime | None, until: datetime | None = None) -> LogSource:
    """The log's messages with ``since <= timestamp < until``, for a replay of what came after a time.

    The connector looks the offsets of the times up. File logs keep messages in a folder for each day, so files
    of other days are not opened, and row groups of other times are skipped; files of earlier logs, which have
    no such folders, are opened. Messages without a time belong to no range.
    """
    return replace(source, since=since, until=until)


def _epoch_millis(time: datetime) -> int:
    return int((time - datetime(1970, 1, 1)) // timedelta(milliseconds=1))


def _timed(rows: DataFrame, since: datetime | None, until: datetime | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(F.col("timestamp") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("timestamp") < F.lit(until))
    return rows


def _days_between(since: datetime | None, until: datetime | None) -> Column:
    """Files that can hold messages of a range, by the folder of their day; those in no such folder can."""
    day = F.regexp_extract("_metadata.file_path", rf"/{DAY}=(\d{{4}}-\d\d-\d\d)/[^/]*$", 1)
    fits = F.lit(True)
    if since is not None:
        fits &= day >= since.date().isoformat()
    if until is not None:
        fits &= day <= until.date().isoformat()
    return (day == "") | fits


def _is_message() -> Column:
    """Rows of a log that are no rejects: by what the row says, and by the folder the gate wrote it to.

    The folder lets whole files go unread. Earlier logs tell rejects by the folder only.
    """
    folder = F.col("_metadata.file_path").rlike(f"/({REJECTS}|{PASSED}=false)/({DAY}=[^/]*/)?[^/]*$")
    return (F.col(PASSED).isNull() | F.col(PASSED)) & ~folder


def gated_rows(rows: DataFrame) -> DataFrame:
    """Rows of the gate with the folders their file belongs in; ``passed`` stays a column of the file."""
    gate = F.when(F.col(PASSED), F.lit("passed")).otherwise(F.lit("rejected"))
    return rows.withColumns({GATE: gate, DAY: F.to_date("timestamp")})


def log_rows(rows: DataFrame) -> DataFrame:
    """Rows of a log in declared types: binary keys and values become text, times zone-free."""
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_ROW))


def replay(
    log: DataFrame, first_offset: int, last_offset: int | None = None, partition: int | None = None
) -> DataFrame:
    """Stored messages of an offset range, both ends included; open-ended without a last one."""
    wanted = F.col("offset") >= first_offset
    if last_offset is not None:
        wanted &= F.col("offset") <= last_offset
    if partition is not None:
        wanted &= F.col("partition") == partition
    return log.filter(wanted)


def offset_range(source: KafkaLog, ranges: Mapping[int, tuple[int, int]]) -> KafkaLog:
    """The topic from the first to the last offset of each partition, both included.

    The connector then reads nothing else; a filter on ``offset`` would read the whole topic.
    Partitions that are not named are not read.
    """
    starts = {source.topic: {str(p): first for p, (first, _) in sorted(ranges.items())}}
    ends = {source.topic: {str(p): last + 1 for p, (_, last) in sorted(ranges.items())}}
    assigned = {"assign": json.dumps({source.topic: sorted(ranges)})}
    return replace(
        source,
        starting_offsets=json.dumps(starts),
        ending_offsets=json.dumps(ends),
        options=dict(source.options) | assigned,
    )


def as_log(messages: DataFrame, partition: int = 0) -> DataFrame:
    """Encoded messages as log rows whose offset is the message's sequence."""
    return messages.select(
        "key",
        "value",
        F.lit(partition).cast("int").alias("partition"),
        F.col("sequence").alias("offset"),
        "timestamp",
    )
