"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.operators import contract, decode, ingest, ohlc, reads
from wickframe.plans.candles import (
    candles_from_log,
    candles_from_raw,
    candles_since,
    quotes_from_raw,
)
from wickframe.schemas import COMPAT, EXACT, PriceMode
from wickframe.session import pin_utc, scratch_dir
from wickframe.sources import quotes
from wickframe.sources.quotes import read_raw
from wickframe.sources.ticklog import FileLog, as_log, between, read_log, replay
from wickframe.streaming.counts import RejectCounts, stored_counts
from wickframe.streaming.paths import delete, mark
from wickframe.streaming.stream import (
    candle_stream,
    start_candle_stream,
    start_ingest_stream,
    start_late_stream,
    start_pane_stream,
)
from wickframe.streaming.table import (
    candles_of_panes,
    candles_with_late,
    compact,
    current_candles,
    latest_candles,
    merge_by_size,
    stored_candles,
    write_backfill,
    write_epoch,
    write_ranked_epoch,
)

Query = Callable[[SparkSession, str], DataFrame]

DAY = ("1 day", "6 hours")
DAY_EACH_MINUTE = ("1 day", "1 minute")
CHUNKS = 4


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.events(pin_utc(spark), sf_dir)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.raw_quotes(_events(spark, sf_dir))


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_raw_quotes(_raw(spark, sf_dir), arrival="arrived")


def _graded(spark: SparkSession, sf_dir: str, mode: PriceMode = EXACT) -> DataFrame:
    return ingest.grade(_quotes(spark, sf_dir), mode)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_log(ingest.encode_messages(ingest.accepted(_graded(spark, sf_dir))))


def _last_offset(spark: SparkSession, sf_dir: str) -> int:
    return _events(spark, sf_dir).agg(F.max("event_id")).first()[0] or 0


def _clean_mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.with_mid(quotes.clean_ticks(_events(spark, sf_dir)))


def _clean_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.candles(_clean_mids(spark, sf_dir))


# Ingest: parse, grade, encode.


def raw_quote_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quotes(spark, sf_dir)


def raw_pair_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_raw(_raw(spark, sf_dir), "arrived", ("clickusdt", "VIEWUSDT"))


def tick_quality_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    bid, ask = F.col("bid"), F.col("ask")
    return _quotes(spark, sf_dir).select(
        "sequence",
        ingest.quality_reason(bid, ask, EXACT).alias("reason_exact"),
        ingest.quality_reason(bid, ask, COMPAT).alias("reason_compat"),
    )


def tick_quality_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted(_graded(spark, sf_dir))


def tick_quality_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.quarantined(_graded(spark, sf_dir))


def tick_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.quality_summary(_graded(spark, sf_dir))


def tick_quality_summary_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.quality_summary(_graded(spark, sf_dir, COMPAT))


def _null_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.null_time_ticks(_events(spark, sf_dir))


def tick_quality_no_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = ingest.grade(_null_time(spark, sf_dir))
    return ingest.quarantined(graded).filter(F.col("reason") == ingest.NO_TIMESTAMP)


def tick_message_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.encode_messages(ingest.accepted(_graded(spark, sf_dir)))


# Decode and mid price.


def tick_message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_messages(_log(spark, sf_dir), EXACT)


def tick_message_decode_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_messages(_log(spark, sf_dir), COMPAT)


def mid_price_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.mids_from_messages(_log(spark, sf_dir), EXACT)


def mid_price_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.mids_from_messages(_log(spark, sf_dir), COMPAT)


def replay_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from halfway through the log to its end, as after a failure at that offset."""
    half = (_last_offset(spark, sf_dir) + 1) // 2
    return replay(_log(spark, sf_dir), first_offset=half, partition=0)


# Windows and candles.


def sliding_window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _null_time(spark, sf_dir).select("sequence", "pair", "timestamp")
    return ohlc.window_bounds(ohlc.assign_windows(ticks))


def candles_5m_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw quote text, parsed and graded, to five-minute candles each minute."""
    return candles_from_raw(_raw(spark, sf_dir), arrival="arrived")


def candles_5m_1m_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_candles(spark, sf_dir)


def candles_5m_1m_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.candles_direct(_clean_mids(spark, sf_dir))


def candles_5m_1m_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_log(_log(spark, sf_dir), mode=COMPAT)


def _null_mid_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    mids = decode.mids_from_quotes(_null_time(spark, sf_dir), COMPAT)
    return ohlc.candles(mids, keep_null_mids=True)


def candles_5m_1m_null_mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _null_mid_candles(spark, sf_dir)


def candles_1d_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles_from_log(_log(spark, sf_dir), *DAY)


def candles_1d_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that overlap 1,440 times."""
    return candles_from_log(_log(spark, sf_dir), *DAY_EACH_MINUTE)


def candles_90m_7m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many windows whose length is no multiple of their slide."""
    return ohlc.candles(_clean_mids(spark, sf_dir), "90 minutes", "7 minutes")


def _from_stored_panes(
    spark: SparkSession, sf_dir: str, width: str, size: str, slide: str
) -> DataFrame:
    """Candles rolled up from a stored pane table, without reading ticks again."""
    path = scratch_dir(spark, "panes")
    pane_bars = ohlc.panes(_clean_mids(spark, sf_dir), width, width)
    pane_bars.write.mode("overwrite").parquet(path)
    return ohlc.roll_up(spark.read.schema(pane_bars.schema).parquet(path), size, slide)


def candles_from_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_stored_panes(spark, sf_dir, "1 minute", ohlc.SIZE, ohlc.SLIDE)


def candles_1d_6h_from_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_stored_panes(spark, sf_dir, "1 hour", *DAY)


def candle_low_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.low_high(_clean_candles(spark, sf_dir))


def candle_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.open_close(ohlc.candles(_clean_mids(spark, sf_dir), *DAY))


# Table contract and reads.


def candle_not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.not_null_violations(_null_mid_candles(spark, sf_dir))


def candle_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of which the table stores several versions, before readers take the newest."""
    return contract.unique_violations(stored_candles(spark, _upserted(spark, sf_dir)))


def candles_ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.ordered(_clean_candles(spark, sf_dir), 30)


def latest_12_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.latest(_clean_candles(spark, sf_dir), 12)


def latest_12_disjoint_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.latest_disjoint(_clean_candles(spark, sf_dir), 12)


def _upserted(
    spark: SparkSession, sf_dir: str, between: Callable[[str, int], object] = lambda table, epoch: None
) -> str:
    """A table after four epochs; each holds the candles of its own quarter of the ticks."""
    table = scratch_dir(spark, "table")
    mids = _clean_mids(spark, sf_dir)
    for epoch in range(CHUNKS):
        batch = mids.filter(F.col("sequence") % CHUNKS == epoch)
        write_epoch(ohlc.candles(batch, *DAY), table, epoch)
        between(table, epoch)
    return table


def upsert_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_candles(spark, _upserted(spark, sf_dir))


def _small_epochs(spark: SparkSession, sf_dir: str, epochs: int = 10, fanout: int = 3) -> str:
    """A table of many epochs of candles that change from epoch to epoch, merged by size as they come."""
    table = scratch_dir(spark, "sizes")
    rows = _clean_candles(spark, sf_dir).withColumn("nth", F.pmod(F.xxhash64("open_time"), F.lit(epochs)))
    rows = rows.persist()
    for epoch in range(epochs):
        # Candles come with wrong prices first, in one epoch or another, and all right in the last.
        wrong = rows.filter(F.col("nth") == epoch)
        wrong = wrong.withColumn("close_price", (F.col("close_price") + 1).cast("decimal(20,8)"))
        write_epoch((rows if epoch == epochs - 1 else wrong).drop("nth"), table, epoch)
        merge_by_size(spark, table, fanout=fanout, keep_for=0 if epoch % 2 else 3600)
    rows.unpersist()
    return table


def upsert_merged_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_candles(spark, _small_epochs(spark, sf_dir))


def latest_12_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest candles of the stored table, from its newest dates."""
    return latest_candles(spark, _small_epochs(spark, sf_dir), 12)


def latest_12_disjoint_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_candles(spark, _small_epochs(spark, sf_dir), 12, reads.latest_disjoint)


def upsert_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _upserted(spark, sf_dir)
    compact(spark, table, CHUNKS - 1)
    return current_candles(spark, table)


def upsert_compact_ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compactions that name an epoch still to come, after each epoch."""
    ahead = CHUNKS + 6
    table = _upserted(spark, sf_dir, lambda path, epoch: compact(spark, path, ahead))
    return current_candles(spark, table)


def compact_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compaction again after it was lost, with no mark of the committer left."""

    def lose(path: str, epoch: int) -> None:
        if epoch == 1:
            compact(spark, path)
            delete(spark, f"{path}/version={2 * epoch + 1}/_SUCCESS")

    table = _upserted(spark, sf_dir, lose)
    compact(spark, table, 1)
    compact(spark, table)
    return current_candles(spark, table)


def _any_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid prices whose times tie by the minute and whose sequences span the whole range, and more.

    An id times 10**13 is past BIGINT from 922,338 on, so sequences are decimals that hold it for every id.
    """
    whole = F.col("sequence").cast("decimal(19,0)")
    spread = (
        F.when(F.col("sequence") % 3 == 0, -whole)
        .when(F.col("sequence") % 3 == 1, whole * F.lit(str(10**13)).cast("decimal(14,0)"))
        .otherwise(whole)
    )
    minute = F.date_trunc("minute", "timestamp").cast("timestamp_ntz")
    return _clean_mids(spark, sf_dir).withColumns({"sequence": spread, "timestamp": minute})


def candles_any_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlc.candles(_any_sequence(spark, sf_dir), *DAY)


def message_sequence_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose offsets are in no order, decoded to candles by the sequence they carry."""
    minute = F.date_trunc("minute", "timestamp").cast("timestamp_ntz")
    ticks = ingest.accepted(_graded(spark, sf_dir)).withColumn("timestamp", minute)
    log = as_log(ingest.encode_messages(ticks, with_sequence=True))
    shuffled = log.withColumn("offset", F.abs(F.xxhash64("offset")))
    return ohlc.candles(decode.mids_from_messages(shuffled), *DAY)


def tick_quality_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of nine decimals: those the type cannot hold are told, not rounded."""
    ticks = _quotes(spark, sf_dir).select(
        "sequence",
        "pair",
        F.format_string("%d.%09d", F.col("sequence"), F.col("sequence") % 100).alias("bid"),
        F.lit("1.50").alias("ask"),
        "timestamp",
    )
    return ingest.grade(ticks).select("sequence", "bid", "reason")


def tick_quality_no_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of ticks of which every seventh has no pair; those make no candle."""
    pair = F.when(F.col("sequence") % 7 != 0, F.col("pair"))
    return ohlc.candles(_clean_mids(spark, sf_dir).withColumn("pair", pair), *DAY)


# Streams. Each runs to the end of its input and returns the table it leaves.


def _files_per_trigger(spark: SparkSession, path: str, triggers: int) -> int:
    files = read_log(spark, FileLog(path)).inputFiles()
    return max(1, -(-len(files) // triggers))


def _stream_log(
    spark: SparkSession, path: str, checkpoint: str, table: str, triggers: int, *window: str
) -> None:
    source = FileLog(path, max_files_per_trigger=_files_per_trigger(spark, path, triggers))
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    changes = candle_stream(mids, *window)
    query = start_candle_stream(changes, table, checkpoint, trigger={"availableNow": True})
    query.awaitTermination()


def _write_chunks(log: DataFrame, path: str, chunk: Column) -> None:
    """Files per chunk, so that a stream takes several micro-batches; chunks are the whole log."""
    log.withColumn("chunk", chunk).write.partitionBy("chunk").parquet(path)


def _write_interleaved(log: DataFrame, path: str) -> None:
    """Chunks that each span the whole time range: all but the first are late data."""
    _write_chunks(log, path, F.col("offset") % CHUNKS)


def stream_source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per key, read as a stream; each micro-batch adds its counts under its epoch."""
    base = scratch_dir(pin_utc(spark), "source")
    _write_interleaved(_log(spark, sf_dir), f"{base}/log")
    per_trigger = _files_per_trigger(spark, f"{base}/log", CHUNKS)
    source = FileLog(f"{base}/log", max_files_per_trigger=per_trigger)

    def count_batch(batch: DataFrame, epoch_id: int) -> None:
        counts = batch.groupBy("key").agg(F.count(F.lit(1)).alias("messages"))
        counts.write.mode("overwrite").parquet(f"{base}/counts/epoch_id={epoch_id}")

    query = (
        read_log(spark, source, streaming=True)
        .writeStream.foreachBatch(count_batch)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    counts = spark.read.schema("key string, messages long").parquet(f"{base}/counts")
    return counts.groupBy("key").agg(F.sum("messages").alias("messages"))


def tick_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw quote files through the ingest stream; what passed the gate is the log."""
    base = scratch_dir(pin_utc(spark), "ingest")
    raw = _raw(spark, sf_dir)
    raw.write.parquet(f"{base}/raw")
    stored = spark.readStream.schema(raw.schema).parquet(f"{base}/raw")
    quoted = ingest.parse_raw_quotes(stored, arrival="arrived")
    query = start_ingest_stream(
        quoted, f"{base}/log", f"{base}/checkpoint", trigger={"availableNow": True}
    )
    query.awaitTermination()
    return read_log(spark, FileLog(f"{base}/log"))


def log_read_ungated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log the ingest stream wrote, read without being told that rejects lie next to it."""
    base = scratch_dir(pin_utc(spark), "ingest")
    _raw(spark, sf_dir).write.parquet(f"{base}/raw")
    stored = read_raw(spark, f"{base}/raw", streaming=True, format="parquet", arrival="arrived")
    quoted = ingest.parse_raw_quotes(stored, arrival="arrived")
    start_ingest_stream(
        quoted, f"{base}/log", f"{base}/checkpoint", trigger={"availableNow": True}
    ).awaitTermination()
    return read_log(spark, FileLog(f"{base}/log"))


def log_stream_before_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream set up and started on an empty folder; the ingest stream writes the log there afterwards."""
    base = scratch_dir(pin_utc(spark), "early")
    mark(spark, f"{base}/log")
    log = read_log(spark, FileLog(f"{base}/log"), streaming=True)
    sink = log.writeStream.format("parquet").option("path", f"{base}/copy")
    reader = sink.option("checkpointLocation", f"{base}/reader").start()
    try:
        reader.processAllAvailable()
        _raw(spark, sf_dir).write.parquet(f"{base}/raw")
        stored = read_raw(spark, f"{base}/raw", streaming=True, format="parquet", arrival="arrived")
        quoted = ingest.parse_raw_quotes(stored, arrival="arrived")
        start_ingest_stream(
            quoted, f"{base}/log", f"{base}/checkpoint", trigger={"availableNow": True}
        ).awaitTermination()
        reader.processAllAvailable()
    finally:
        reader.stop()
    return spark.read.schema(log.schema).parquet(f"{base}/copy")


def stream_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by reason as the ingest stream counts them, batch by batch; its log is not read."""
    base = scratch_dir(pin_utc(spark), "counts")
    _raw(spark, sf_dir).repartition(CHUNKS).write.parquet(f"{base}/raw")
    stored = read_raw(
        spark, f"{base}/raw", streaming=True, format="parquet", arrival="arrived", max_files_per_trigger=1
    )
    counts = RejectCounts(f"{base}/counts")
    spark.streams.addListener(counts)
    try:
        query = start_ingest_stream(
            ingest.parse_raw_quotes(stored, arrival="arrived"),
            f"{base}/log",
            f"{base}/checkpoint",
            trigger={"availableNow": True},
        )
        query.awaitTermination()
        counts.wait_for(query)
    finally:
        spark.streams.removeListener(counts)
    return stored_counts(spark, f"{base}/counts").groupBy("reason").agg(F.sum("ticks").alias("ticks"))


def _ingested(spark: SparkSession, sf_dir: str) -> FileLog:
    """The log as the ingest stream leaves it."""
    base = scratch_dir(pin_utc(spark), "ingested")
    _raw(spark, sf_dir).write.parquet(f"{base}/raw")
    stored = read_raw(spark, f"{base}/raw", streaming=True, format="parquet", arrival="arrived")
    quoted = ingest.parse_raw_quotes(stored, arrival="arrived")
    start_ingest_stream(
        quoted, f"{base}/log", f"{base}/checkpoint", trigger={"availableNow": True}
    ).awaitTermination()
    return FileLog(f"{base}/log")


def _failure(spark: SparkSession, sf_dir: str) -> datetime:
    """A quarter past ten, three days before the last event."""
    last = _events(spark, sf_dir).agg(F.max("ts")).first()[0]
    return datetime.combine((last - timedelta(days=3)).date(), time(10, 15))


def replay_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from a time on, as after a failure then."""
    return read_log(spark, between(_ingested(spark, sf_dir), _failure(spark, sf_dir)))


def candles_replayed_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candles that a failure at a time can have left wrong, from no more of the log than they need."""
    return candles_since(spark, _ingested(spark, sf_dir), _failure(spark, sf_dir))


def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of every second message backfilled twice, then the whole log streamed into the table."""
    base = scratch_dir(pin_utc(spark), "continued")
    log = _log(spark, sf_dir)
    for part in range(2):
        write_backfill(candles_from_log(log.where(F.col("offset") % 2 == part), *DAY), f"{base}/table")
    _write_interleaved(log, f"{base}/log")
    _stream_log(spark, f"{base}/log", f"{base}/checkpoint", f"{base}/table", CHUNKS, *DAY)
    return current_candles(spark, f"{base}/table")


def candle_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(pin_utc(spark), "stream")
    in_order = F.floor(F.col("offset") * CHUNKS / (_last_offset(spark, sf_dir) + 1))
    _write_chunks(_log(spark, sf_dir), f"{base}/log", in_order)
    _stream_log(spark, f"{base}/log", f"{base}/checkpoint", f"{base}/table", CHUNKS)
    return current_candles(spark, f"{base}/table")


def candle_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(pin_utc(spark), "late")
    _write_interleaved(_log(spark, sf_dir), f"{base}/log")
    _stream_log(spark, f"{base}/log", f"{base}/checkpoint", f"{base}/table", CHUNKS, *DAY)
    return current_candles(spark, f"{base}/table")


def candle_stream_watermark_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks in which most ticks lie behind the watermark: state stays small, and readers merge what it dropped."""
    base = scratch_dir(pin_utc(spark), "watermark")
    _write_interleaved(_log(spark, sf_dir), f"{base}/log")
    per_trigger = _files_per_trigger(spark, f"{base}/log", CHUNKS)
    source = FileLog(f"{base}/log", max_files_per_trigger=per_trigger)
    now = {"availableNow": True}
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    changes = candle_stream(mids, *DAY, watermark="10 minutes", ranks=True)
    start_candle_stream(
        changes, f"{base}/table", f"{base}/candles", trigger=now, upsert=write_ranked_epoch
    ).awaitTermination()
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    start_late_stream(
        mids, f"{base}/late", f"{base}/parts", "10 minutes", width=DAY[1], trigger=now
    ).awaitTermination()
    return candles_with_late(spark, f"{base}/table", f"{base}/late", *DAY)


def candle_pane_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late chunks again, as a stateless stream of pane parts that readers merge to candles."""
    base = scratch_dir(pin_utc(spark), "panes")
    path, table = f"{base}/log", f"{base}/table"
    _write_interleaved(_log(spark, sf_dir), path)
    source = FileLog(path, max_files_per_trigger=_files_per_trigger(spark, path, CHUNKS))
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    query = start_pane_stream(mids, table, f"{base}/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    return candles_of_panes(spark, table)


def restart_no_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop halfway through the offsets, inside windows, and resume on the same checkpoint."""
    base = scratch_dir(pin_utc(spark), "restart")
    log = _log(spark, sf_dir)
    half = (_last_offset(spark, sf_dir) + 1) // 2
    for part in (replay(log, 0, half - 1), replay(log, half)):
        part.write.mode("append").parquet(f"{base}/log")
        _stream_log(spark, f"{base}/log", f"{base}/checkpoint", f"{base}/table", 2, *DAY)
    return current_candles(spark, f"{base}/table")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        raw_quote_parse,
        raw_pair_subset,
        tick_quality_reason,
        tick_quality_accept,
        tick_quality_reject,
        tick_quality_summary,
        tick_quality_summary_compat,
        tick_quality_no_timestamp,
        tick_message_encode,
        tick_message_decode,
        tick_message_decode_compat,
        mid_price_exact,
        mid_price_compat,
        replay_offset_range,
        sliding_window_assign,
        candles_5m_1m,
        candles_5m_1m_clean,
        candles_5m_1m_direct,
        candles_5m_1m_compat,
        candles_5m_1m_null_mids,
        candles_1d_6h,
        candles_1d_1m,
        candles_90m_7m,
        candles_from_panes,
        candles_1d_6h_from_panes,
        candle_low_high,
        candle_open_close,
        candle_not_null_violations,
        candle_unique_violations,
        candles_ordered_limit,
        latest_12_candles,
        latest_12_disjoint_candles,
        upsert_latest_wins,
        upsert_merged_by_size,
        latest_12_from_table,
        latest_12_disjoint_from_table,
        upsert_compacted,
        upsert_compact_ahead,
        compact_resumed,
        candles_any_sequence,
        message_sequence_order,
        tick_quality_precision,
        tick_quality_no_pair,
        log_read_ungated,
        log_stream_before_ingest,
        stream_reject_counts,
        replay_from_time,
        candles_replayed_from_time,
        backfill_then_stream,
        tick_log_stream,
        stream_source_count,
        candle_stream_upsert,
        candle_stream_late,
        candle_stream_watermark_late,
        candle_pane_stream,
        restart_no_regression,
    )
}
