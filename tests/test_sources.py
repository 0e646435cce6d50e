"""Log sources and their options."""

from __future__ import annotations

from datetime import datetime

import pytest
from plans import files_read
from pyspark.sql import functions as F

from wickframe import session
from wickframe.sources import ticklog
from wickframe.sources.ticklog import (
    FileLog,
    KafkaLog,
    between,
    kafka_options,
    offset_range,
    read_log,
    replay,
)

KAFKA = KafkaLog(("localhost:9092", "other:9092"), "ticks", min_partitions=64,
                 max_offsets_per_trigger=1000, options={"failOnDataLoss": "true"})


def test_kafka_options():
    streaming = kafka_options(KAFKA, streaming=True)
    assert streaming["kafka.bootstrap.servers"] == "localhost:9092,other:9092"
    assert streaming["subscribe"] == "ticks"
    assert streaming["startingOffsets"] == "earliest"
    assert streaming["minPartitions"] == "64"
    assert streaming["maxOffsetsPerTrigger"] == "1000"
    assert streaming["failOnDataLoss"] == "true"
    assert "endingOffsets" not in streaming
    batch = kafka_options(KAFKA, streaming=False)
    assert batch["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in batch
    latest = KafkaLog(("h:1",), "t", starting_offsets="latest")
    assert kafka_options(latest, True)["startingOffsets"] == "latest"


@pytest.fixture
def log_rows(spark):
    at = datetime(2021, 1, 1)
    data = [("P", "{}", partition, offset, at) for partition in (0, 1) for offset in range(10)]
    return spark.createDataFrame(
        data, "key string, value string, partition int, offset long, timestamp timestamp_ntz"
    )


def test_topic_rows_become_log_rows(spark, log_rows):
    topic = log_rows.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("ticks").alias("topic"),
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    back = ticklog.log_rows(topic)
    assert back.schema.simpleString() == log_rows.schema.simpleString()
    assert sorted(back.collect()) == sorted(log_rows.collect())


def test_without_the_connector_a_topic_is_refused_by_name(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_log(spark, KAFKA)


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_file_log_round_trip(spark, log_rows, tmp_path, format):
    path = str(tmp_path / format)
    log_rows.write.format(format).save(path)
    back = read_log(spark, FileLog(path, format))
    assert back.schema.simpleString() == log_rows.schema.simpleString()
    assert sorted(back.collect()) == sorted(log_rows.collect())


def test_replay_ranges(log_rows):
    assert replay(log_rows, 3).count() == 14
    assert replay(log_rows, 3, 5).count() == 6
    assert [r.offset for r in replay(log_rows, 3, 5, partition=1).collect()] == [3, 4, 5]


def test_scratch_dir_needs_a_shared_folder_off_local_masters(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        master = "spark://cluster:7077"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session(), "x")
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert session.scratch_dir(Session(), "x").startswith("hdfs:///shared/x-")
    Session.conf.clear()
    Context.master = "local[2]"
    assert "/x-" in session.scratch_dir(Session(), "x")


def test_replay_of_a_topic_reads_its_offsets_only():
    source = KafkaLog(("a:1",), "ticks", min_partitions=4)
    options = kafka_options(offset_range(source, {1: (5, 9), 0: (2000, 2999)}), streaming=False)
    assert options["startingOffsets"] == '{"ticks": {"0": 2000, "1": 5}}'
    assert options["endingOffsets"] == '{"ticks": {"0": 3000, "1": 10}}'
    assert options["assign"] == '{"ticks": [0, 1]}' and "subscribe" not in options
    assert options["minPartitions"] == "4"


def _gate_rows(spark):
    rows = [("P", "good", 0, 1, True), ("P", "reject", 0, 2, False)]
    df = spark.createDataFrame(rows, "key string, value string, partition int, offset long, passed boolean")
    return df.withColumn("timestamp", F.lit(datetime(2021, 1, 1)).cast("timestamp_ntz"))


@pytest.mark.parametrize("format", ["parquet", "json"])
@pytest.mark.parametrize("kind", ["new", "by folder", "plain"])
def test_logs_tell_their_rejects(spark, tmp_path, kind, format):
    """Rows say whether they passed; earlier logs by their folder; plain logs have no rejects."""
    rows = _gate_rows(spark)
    if kind == "new":
        rows = ticklog.gated_rows(rows).write.partitionBy(ticklog.GATE)
    elif kind == "by folder":
        rows = rows.write.partitionBy("passed")
    else:
        rows = rows.drop("passed").write
    rows.format(format).save(f"{tmp_path}/log")
    read = read_log(spark, FileLog(f"{tmp_path}/log", format))
    assert {r.value for r in read.collect()} == ({"good", "reject"} if kind == "plain" else {"good"})
    assert read_log(spark, FileLog(f"{tmp_path}/log", format, gated=False)).count() == 2


@pytest.mark.parametrize("kind", ["new", "by folder"])
def test_a_stream_set_up_on_an_empty_folder_takes_no_reject(spark, tmp_path, kind):
    (tmp_path / "log").mkdir()
    rows = read_log(spark, FileLog(f"{tmp_path}/log"), streaming=True)
    sink = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query = sink.option("checkpointLocation", f"{tmp_path}/c").start()
    try:
        query.processAllAvailable()
        gate = _gate_rows(spark)
        gate = ticklog.gated_rows(gate).write.partitionBy(ticklog.GATE) if kind == "new" else gate.write.partitionBy("passed")
        gate.mode("append").parquet(f"{tmp_path}/log")
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["good"]


def test_files_of_rejects_are_not_opened(spark, tmp_path):
    ticklog.gated_rows(_gate_rows(spark)).write.partitionBy(ticklog.GATE).parquet(f"{tmp_path}/log")
    for file in (tmp_path / "log" / ticklog.REJECTS).glob("*.parquet"):
        file.write_bytes(b"not a file of this kind")
    assert read_log(spark, FileLog(f"{tmp_path}/log")).count() == 1


def _month_of_log(spark, path, gated=True):
    """A message each hour of thirty days, as the gate writes them or without its folders."""
    rows = spark.range(720).select(
        F.lit("P").alias("key"),
        F.col("id").cast("string").alias("value"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_seconds(1609459200 + 3600 * F.col("id")).cast("timestamp_ntz").alias("timestamp"),
        F.lit(True).alias("passed"),
    )
    writer = ticklog.gated_rows(rows).write.partitionBy(*ticklog.LOG_FOLDERS) if gated else rows.drop("passed").write
    writer.parquet(path)
    return FileLog(path)


@pytest.mark.parametrize("gated", [True, False])
def test_replay_from_a_time(spark, tmp_path, gated):
    log = _month_of_log(spark, f"{tmp_path}/log", gated)
    since, until = datetime(2021, 1, 28, 10, 15), datetime(2021, 1, 30, 0, 0)
    assert read_log(spark, between(log, since)).count() == 3 * 24 - 11
    hours = [r.timestamp for r in read_log(spark, between(log, since, until)).collect()]
    assert min(hours) == datetime(2021, 1, 28, 11) and max(hours) == datetime(2021, 1, 29, 23)
    assert read_log(spark, between(log, None, until)).count() == 29 * 24


def test_a_replay_opens_only_files_of_its_days(spark, tmp_path):
    log = _month_of_log(spark, f"{tmp_path}/log")
    whole = files_read(read_log(spark, log))
    some = files_read(read_log(spark, between(log, datetime(2021, 1, 28, 10, 15))))
    assert whole >= 30 and some * 7 <= whole


def test_a_stream_from_a_time(spark, tmp_path):
    log = _month_of_log(spark, f"{tmp_path}/log")
    rows = read_log(spark, between(log, datetime(2021, 1, 30)), streaming=True)
    sink = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").trigger(availableNow=True)
    sink.option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 24


def test_times_of_a_topic():
    options = kafka_options(between(KAFKA, datetime(2021, 1, 1, 10, 15), datetime(2021, 1, 2)), streaming=False)
    assert options["startingTimestamp"] == "1609496100000"
    assert options["endingTimestamp"] == "1609545600000"
    assert options["startingOffsetsByTimestampStrategy"] == "latest"
    assert "endingTimestamp" not in kafka_options(between(KAFKA, None, datetime(2021, 1, 2)), streaming=True)

