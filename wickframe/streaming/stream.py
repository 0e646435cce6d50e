"""Structured Streaming jobs: quotes to the message log, the log to the candle table."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wickframe.functions.durations import micros
from wickframe.functions.ordering import epoch_micros
from wickframe.operators.ingest import accepted, encode_messages, gate_log, grade
from wickframe.operators.ohlc import SIZE, SLIDE, candles_direct, partial_panes
from wickframe.schemas import EXACT, PriceMode
from wickframe.session import scoped_conf
from wickframe.sources.ticklog import LOG_FOLDERS, gated_rows
from wickframe.streaming import paths
from wickframe.streaming.counts import observed
from wickframe.streaming.delays import Delays
from wickframe.streaming.rowstore import BatchStore
from wickframe.streaming.table import (
    KEEP_FOR,
    merge_by_size,
    next_epoch,
    pane_layout,
    stored_mode,
    write_epoch,
    write_pane_epoch,
)

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_conf(spark: SparkSession, state_partitions: int | None = None) -> dict[str, str]:
    """Options of a stateful query. The partition count is fixed for the life of a checkpoint.

    It is the session's shuffle setting unless given. Every partition commits its state in every
    trigger, so a query with few live keys wants few of them.
    """
    if state_partitions is None:
        state_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {
        "spark.sql.shuffle.partitions": str(state_partitions),
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Counting rows reads every key before it is written.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }


def candle_stream(
    mids: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    *,
    watermark: str | None = None,
    sequence_limit: int | None = None,
    newest_tick: bool = False,
    ranks: bool = False,
) -> DataFrame:
    """Streaming candles. Without a watermark every late tick re-opens its windows.

    A watermark bounds the state and drops ticks that come later than it allows. ``newest_tick`` carries
    the time of each candle's newest tick along, for :class:`wickframe.streaming.delays.Delays`, ``ranks`` what late
    ticks are merged by, for :func:`start_late_stream`.
    """
    if watermark is not None:
        # Watermarks need a zoned timestamp; candle times are zone-free again on the way out.
        mids = mids.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        mids = mids.withWatermark("timestamp", watermark)
    return candles_direct(mids, size, slide, sequence_limit=sequence_limit, newest_tick=newest_tick, ranks=ranks)


def _epoch_shift(spark: SparkSession, table: str, checkpoint: str) -> int:
    """What to add to a query's epochs so that the next one comes after all the table has.

    A new checkpoint may so continue a table that a backfill or another query wrote. An epoch that was
    written but not committed is written once more under its new number, with the same rows.
    """
    committed = [int(n) for n in paths.file_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(0, next_epoch(spark, table) - (max(committed, default=-1) + 1))


def _start(
    sink: DataStreamWriter, checkpoint: str, trigger: dict[str, Any] | None
) -> StreamingQuery:
    if trigger:
        sink = sink.trigger(**trigger)
    return sink.option("checkpointLocation", checkpoint).start()


def _start_stateful(
    rows: DataFrame,
    sink: DataStreamWriter,
    checkpoint: str,
    trigger: dict[str, Any] | None,
    state_partitions: int | None,
) -> StreamingQuery:
    spark = rows.sparkSession
    with scoped_conf(spark, state_conf(spark, state_partitions)):
        return _start(sink, checkpoint, trigger)


def start_candle_stream(
    candle_changes: DataFrame,
    table: str,
    checkpoint: str,
    *,
    trigger: dict[str, Any] | None = None,
    state_partitions: int | None = None,
    merge_files: bool = True,
    upsert: Callable[[DataFrame, str, int, bool], Any] = write_epoch,
    fanout: int | None = None,
    keep_for: float = KEEP_FOR,
    delays: Delays | None = None,
) -> StreamingQuery:
    """Keep the candle table current: update mode, one epoch per micro-batch.

    The checkpoint resumes offsets and state, so a restart inside a window continues its candle
    instead of rebuilding it from what comes after. Without ``trigger`` batches run back to back.
    ``merge_files=False`` spares each epoch a shuffle and writes a file per state partition and date.
    ``delays`` is told how long ticks took until their candle could be read; the changes then have
    ``newest_tick``. With ``fanout`` epochs are merged by size as they pile up, so that reads stay as they are however long
    the stream runs; readers have ``keep_for`` seconds before files that were merged are removed.
    """
    spark = candle_changes.sparkSession
    shift = _epoch_shift(spark, table, checkpoint)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        with delays.measured(batch, epoch_id) if delays else nullcontext(batch) as rows:
            upsert(rows, table, epoch_id + shift, merge_files)
        if fanout:
            merge_by_size(batch.sparkSession, table, None, fanout, keep_for)

    sink = candle_changes.writeStream.outputMode("update").foreachBatch(write_batch)
    return _start_stateful(candle_changes, sink, checkpoint, trigger, state_partitions)


def start_pane_stream(
    mids: DataFrame,
    table: str,
    checkpoint: str,
    *,
    width: str = SLIDE,
    sequence_limit: int | None = None,
    trigger: dict[str, Any] | None = None,
    upsert: Callable[[DataFrame, str, int], Any] = write_pane_epoch,
    fanout: int | None = None,
    keep_for: float = KEEP_FOR,
) -> StreamingQuery:
    """Keep a pane table current without state: each micro-batch adds its parts of panes.

    The way for feeds so large or so late that keeping every window in state is too much. Each tick
    is aggregated once instead of once per window, ticks of any age count, and
    ``table.candles_of_panes`` gives the candles.
    """
    shift = _epoch_shift(mids.sparkSession, table, checkpoint)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        upsert(partial_panes(batch, width, sequence_limit=sequence_limit), table, epoch_id + shift)
        if fanout:
            layout = pane_layout(stored_mode(batch.sparkSession, table, "panes", None))
            merge_by_size(batch.sparkSession, table, layout, fanout, keep_for)

    return _start(mids.writeStream.foreachBatch(write_batch), checkpoint, trigger)


def start_row_store_stream(
    candle_changes: DataFrame,
    row_writer: Any,
    checkpoint: str,
    *,
    trigger: dict[str, Any] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Send changed candles to a writer object with ``open``, ``process`` and ``close``."""
    sink = candle_changes.writeStream.outputMode("update").foreach(row_writer)
    return _start_stateful(candle_changes, sink, checkpoint, trigger, state_partitions)


def start_late_stream(
    mids: DataFrame,
    table: str,
    checkpoint: str,
    watermark: str,
    *,
    width: str = SLIDE,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Keep what a candle stream with this watermark may have dropped, as parts of panes beside its candles.

    A stream with a watermark drops a tick for windows that ended before the newest time of earlier batches, less
    the delay. This one takes all ticks that are so far behind the newest time it has seen, its own batch
    included: all that can have been dropped, as long as both read the log in one order, as files and the partition of a
    topic are read. Ticks that were not dropped after all do no harm, since merging a tick twice changes nothing
    (``table.candles_with_late``). It has no state but that time, which it marks before it writes.
    """
    spark = mids.sparkSession
    shift = _epoch_shift(spark, table, checkpoint)
    delay = micros(watermark)
    top = f"{table}/_seen"

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        at = epoch_micros(F.col("timestamp"))
        batch = batch.persist()
        try:
            before = [int(name) for name in paths.children(spark, top)]
            newest = max([*before, batch.agg(F.max(at)).first()[0] or 0], default=0)
            paths.mark(spark, f"{top}/{newest}")
            late = batch.filter(at < newest - delay)
            write_pane_epoch(partial_panes(late, width), table, epoch_id + shift)
            for name in before:
                if name < newest:
                    paths.delete(spark, f"{top}/{name}")
        finally:
            batch.unpersist()

    return _start(mids.writeStream.foreachBatch(write_batch), checkpoint, trigger)


def start_batch_store_stream(
    candle_changes: DataFrame,
    store: BatchStore,
    checkpoint: str,
    *,
    trigger: dict[str, Any] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep a relational table current, one transaction for each micro-batch; a replayed one changes nothing."""

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        store(batch, epoch_id)

    sink = candle_changes.writeStream.outputMode("update").foreachBatch(write_batch)
    return _start_stateful(candle_changes, sink, checkpoint, trigger, state_partitions)


def start_reject_stream(
    rejects: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Keep the messages that a candle stream leaves out, as files. The file sink commits batches exactly once."""
    return _start(rejects.writeStream.format("parquet").option("path", path), checkpoint, trigger)


def start_ingest_stream(
    quotes: DataFrame,
    log_path: str,
    checkpoint: str,
    *,
    mode: PriceMode = EXACT,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Grade quotes once and write log rows and rejects side by side, as files.

    Rows with ``passed = true`` are the log (``read_log`` takes only them), the others what the gate
    turned away, with its reason, in a folder of their own; both by day. The file sink commits batches exactly once.
    Each batch's progress has its ticks by reason (:class:`wickframe.streaming.counts.RejectCounts`).
    """
    rows = gated_rows(observed(gate_log(quotes, mode)))
    sink = rows.writeStream.format("parquet").partitionBy(*LOG_FOLDERS)
    return _start(sink.option("path", log_path), checkpoint, trigger)


def start_kafka_producer(
    quotes: DataFrame,
    servers: tuple[str, ...],
    topic: str,
    checkpoint: str,
    *,
    mode: PriceMode = EXACT,
    trigger: dict[str, Any] | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Send what the gate accepts to a topic, keyed by pair (needs Spark's Kafka connector)."""
    messages = encode_messages(accepted(grade(quotes, mode)), with_sequence=True).select("key", "value")
    sink = messages.writeStream.format("kafka").options(**(options or {}))
    sink = sink.option("kafka.bootstrap.servers", ",".join(servers)).option("topic", topic)
    return _start(sink, checkpoint, trigger)
