"""Streams: equal to batch, safe to stop, replay and restart."""

from __future__ import annotations

import json
import sqlite3
import sys
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wickframe.operators import decode, ingest
from wickframe.plans.candles import candles_from_log, candles_from_raw
from wickframe.schemas import CANDLE_COLUMNS
from wickframe.sources import quotes
from wickframe.sources.quotes import read_raw
from wickframe.sources.ticklog import FileLog, as_log, read_log
from wickframe.streaming import rowstore
from wickframe.streaming.counts import RejectCounts, stored_counts
from wickframe.streaming.delays import Delays
from wickframe.streaming.rowstore import (
    BatchStore,
    RowStoreWriter,
    batch_store_ddl,
    table_ddl,
    upsert_statement,
)
from wickframe.streaming.stream import (
    candle_stream,
    start_batch_store_stream,
    start_candle_stream,
    start_ingest_stream,
    start_kafka_producer,
    start_late_stream,
    start_pane_stream,
    start_row_store_stream,
    state_conf,
)
from wickframe.streaming.table import (
    candles_of_panes,
    candles_with_late,
    compact,
    current_candles,
    pane_layout,
    write_epoch,
    write_pane_epoch,
    write_ranked_epoch,
)

NOW = {"availableNow": True}
DAY = ("1 day", "6 hours")


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "all")
    quoted = ingest.parse_raw_quotes(quotes.raw_quotes(quotes.events(spark, sf_dir)), "arrived")
    messages = as_log(ingest.encode_messages(ingest.accepted(ingest.grade(quoted))))
    messages.coalesce(1).write.parquet(path)
    return read_log(spark, FileLog(path))


@pytest.fixture(scope="module")
def batch_candles(log):
    return rows(candles_from_log(log, *DAY))


def rows(candles):
    return sorted(tuple(r) for r in candles.select(*CANDLE_COLUMNS).collect())


def start(spark, base, window=DAY, upsert=write_epoch, **options):
    source = FileLog(f"{base}/log", max_files_per_trigger=1)
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    changes = candle_stream(mids, *window, **options)
    return start_candle_stream(
        changes, f"{base}/table", f"{base}/checkpoint", trigger=NOW, upsert=upsert
    )


def append(part, base):
    part.coalesce(1).write.mode("append").parquet(f"{base}/log")


def table(spark, base):
    return rows(current_candles(spark, f"{base}/table"))


def test_stream_equals_batch_whatever_the_arrival_order(spark, log, batch_candles, tmp_path):
    for chunk in (3, 0, 2, 1):
        append(log.filter(F.col("offset") % 4 == chunk).orderBy(F.rand(5)), tmp_path)
    query = start(spark, tmp_path)
    query.awaitTermination()
    assert sum(1 for p in query.recentProgress if p.numInputRows) == 4
    assert table(spark, tmp_path) == batch_candles


def test_restart_inside_windows_continues_them(spark, log, batch_candles, tmp_path):
    for part in (log.filter("offset < 5000"), log.filter("offset >= 5000")):
        append(part, tmp_path)
        start(spark, tmp_path).awaitTermination()
    assert table(spark, tmp_path) == batch_candles


def test_batch_that_failed_after_its_write_is_replayed(spark, log, batch_candles, tmp_path):
    for chunk in range(3):
        append(log.filter(F.col("offset") % 3 == chunk), tmp_path)
    epochs = []

    def write_then_fail_once(batch, path, epoch_id, merge_files):
        write_epoch(batch, path, epoch_id, merge_files)
        epochs.append(epoch_id)
        if epochs == [0, 1]:
            raise RuntimeError("lost before the commit")

    with pytest.raises(Exception, match="lost before the commit"):
        start(spark, tmp_path, upsert=write_then_fail_once).awaitTermination()
    start(spark, tmp_path, upsert=write_then_fail_once).awaitTermination()
    assert epochs == [0, 1, 2, 3]  # the second is written again, as the third
    assert table(spark, tmp_path) == batch_candles


def test_new_checkpoint_continues_a_used_table(spark, log, batch_candles, tmp_path):
    append(log.limit(10), tmp_path)
    start(spark, tmp_path).awaitTermination()
    append(log, tmp_path)
    mids = decode.mids_from_messages(read_log(spark, FileLog(f"{tmp_path}/log"), streaming=True))
    start_candle_stream(
        candle_stream(mids, *DAY), f"{tmp_path}/table", f"{tmp_path}/other", trigger={"availableNow": True}
    ).awaitTermination()
    assert table(spark, tmp_path) == batch_candles


def test_watermark_drops_only_what_is_later_than_it(spark, tmp_path):
    at = datetime(2021, 10, 14, 18, 0)

    def tick(offset, minute, price):
        body = '{"bid":"%s","ask":"%s","pair":"P","timestamp":"%s"}'
        time = at + timedelta(minutes=minute)
        return ("P", body % (price, price, time), 0, offset, time)

    batches = [[(0, 0, 1), (1, 60, 2)], [(2, 61, 3)], [(3, 0, 9), (4, 58, 4)]]
    for batch in batches:
        part = spark.createDataFrame(
            [tick(*t) for t in batch],
            "key string, value string, partition int, offset long, timestamp timestamp_ntz",
        )
        append(part, tmp_path)
        start(spark, tmp_path, ("5 minutes", "5 minutes"), watermark="10 minutes").awaitTermination()
    found = {(r[5].hour, r[5].minute): (int(r[1]), int(r[4])) for r in table(spark, tmp_path)}
    # The tick at 18:00 of the last batch is an hour late and ignored, the one at 18:58 is not.
    assert found == {(18, 0): (1, 1), (18, 55): (4, 4), (19, 0): (2, 3)}


def test_stateless_panes_survive_failures_and_compaction(spark, log, batch_candles, tmp_path):
    for chunk in (2, 0, 1):
        append(log.filter(F.col("offset") % 3 == chunk), tmp_path)
    path, epochs = f"{tmp_path}/table", []

    def write_then_fail_once(parts, table, epoch_id):
        write_pane_epoch(parts, table, epoch_id)
        epochs.append(epoch_id)
        if epochs == [0, 1]:
            raise RuntimeError("lost before the commit")

    def run():
        source = FileLog(f"{tmp_path}/log", max_files_per_trigger=1)
        mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
        start_pane_stream(
            mids, path, f"{tmp_path}/c", trigger=NOW, upsert=write_then_fail_once
        ).awaitTermination()

    with pytest.raises(Exception, match="lost before the commit"):
        run()
    run()
    assert epochs == [0, 1, 2, 3]  # the second is written again, as the third
    assert rows(candles_of_panes(spark, path, *DAY)) == batch_candles
    compact(spark, path, 3, pane_layout())
    assert rows(candles_of_panes(spark, path, *DAY)) == batch_candles
    assert rows(candles_of_panes(spark, path)) == rows(candles_from_log(log))
    since = date(2024, 1, 20)
    later = [r for r in batch_candles if r[5].date() >= since]
    assert later and rows(candles_of_panes(spark, path, *DAY, since=since)) == later


def test_raw_quotes_through_both_streams(spark, sf_dir, tmp_path):
    raw = quotes.raw_quotes(quotes.events(spark, sf_dir))
    raw.coalesce(2).write.parquet(f"{tmp_path}/raw")
    stored = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/raw")
    quoted = ingest.parse_raw_quotes(stored, "arrived")
    start_ingest_stream(quoted, f"{tmp_path}/log", f"{tmp_path}/c1", trigger=NOW).awaitTermination()
    written = spark.read.parquet(f"{tmp_path}/log").withColumn("passed", F.expr("passed = 'true'"))
    assert written.filter("passed").count() == 9_400
    reasons = {r.reason: r["count"] for r in written.filter("not passed").groupBy("reason").count().collect()}
    assert reasons == {"missing": 200, "non_numeric": 400}

    source = FileLog(f"{tmp_path}/log", gated=True)
    assert read_log(spark, source).count() == 9_400
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    start_candle_stream(
        candle_stream(mids), f"{tmp_path}/table", f"{tmp_path}/c2", trigger=NOW
    ).awaitTermination()
    assert table(spark, tmp_path) == rows(candles_from_raw(raw, "arrived"))


def test_row_store_writer_upserts(spark, log, batch_candles, tmp_path):
    file = str(tmp_path / "candles.db")
    with sqlite3.connect(file) as db:
        db.execute(table_ddl("candle"))

    # Local functions travel to the tasks by value.
    def connect():
        return sqlite3.connect(file, timeout=60)

    def as_text(value):
        return value if isinstance(value, str) else str(value)

    for chunk in range(2):
        append(log.filter(F.col("offset") % 2 == chunk), tmp_path)
    source = FileLog(f"{tmp_path}/log", max_files_per_trigger=1)
    mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
    writer = RowStoreWriter(connect, "candle", marker="?", rows_per_commit=50, convert=as_text)
    start_row_store_stream(
        candle_stream(mids, *DAY), writer, f"{tmp_path}/c", trigger=NOW, state_partitions=2
    ).awaitTermination()
    with sqlite3.connect(file) as db:
        stored = db.execute(f"select {', '.join(CANDLE_COLUMNS)} from candle").fetchall()
    # The store keeps numbers as binary floats.
    expected = [(r[0], *map(float, r[1:5]), str(r[5]), str(r[6])) for r in batch_candles]
    assert sorted(stored) == sorted(expected)


def test_row_store_writer_discards_a_failed_task():
    db = sqlite3.connect(":memory:")
    db.execute(table_ddl("t"))
    writer = RowStoreWriter(lambda: db, "t", marker="?", rows_per_commit=10)
    row = dict.fromkeys(CANDLE_COLUMNS, 1)
    assert writer.open(0, 0)
    writer.process(row)
    writer.close(RuntimeError("task failed"))
    assert db.execute("select count(*) from t").fetchone() == (0,)
    assert "close_time = excluded" not in upsert_statement("t")


def test_topic_sink_needs_the_connector(spark, sf_dir, tmp_path):
    raw = quotes.raw_quotes(quotes.events(spark, sf_dir))
    raw.write.parquet(f"{tmp_path}/raw")
    stored = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/raw")
    with pytest.raises(Exception, match="(?i)kafka"):
        start_kafka_producer(
            ingest.parse_raw_quotes(stored, "arrived"), ("localhost:9",), "t", f"{tmp_path}/c"
        )


def test_state_options(spark):
    assert state_conf(spark)["spark.sql.shuffle.partitions"] == "4"
    assert state_conf(spark, 2)["spark.sql.shuffle.partitions"] == "2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


@pytest.fixture
def store(tmp_path):
    file = str(tmp_path / "store.db")
    with sqlite3.connect(file) as db:
        for statement in batch_store_ddl("candle"):
            db.execute(statement)

    def connect():
        return sqlite3.connect(file, timeout=60)

    return BatchStore(connect, "candle", "test", marker="?", as_text=True)


def _rows_of(store, table="candle", columns=CANDLE_COLUMNS):
    with store.connect() as db:
        return sorted(db.execute(f"select {', '.join(columns)} from {table}").fetchall(), key=repr)


def _as_stored(rows):
    times = "%Y-%m-%d %H:%M:%S.%f"
    return sorted(((r[0], *map(float, r[1:5]), *(t.strftime(times) for t in r[5:])) for r in rows), key=repr)


def test_batch_store_keeps_a_table_current(spark, log, batch_candles, tmp_path, store):
    for chunk in range(3):
        append(log.filter(F.col("offset") % 3 == chunk), tmp_path)
    source = FileLog(f"{tmp_path}/log", max_files_per_trigger=1)
    for _ in range(2):  # the second start finds nothing new
        mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
        start_batch_store_stream(
            candle_stream(mids, *DAY), store, f"{tmp_path}/c", trigger=NOW, state_partitions=2
        ).awaitTermination()
    assert _rows_of(store) == _as_stored(batch_candles)
    assert _rows_of(store, "candle_staging", ("run",)) == []
    ((stream, epoch),) = _rows_of(store, "candle_epochs", ("stream", "epoch"))
    assert stream == "test" and epoch >= 2


def _store_batch(spark, n, price, pair="P"):
    at = datetime(2021, 1, 1)
    rows = [(f"{pair}{i}", *[Decimal(price)] * 4, at, at) for i in range(n)]
    return spark.createDataFrame(rows, _NULLABLE)


_NULLABLE = (
    "currency_pair string, open_price decimal(20,8), high_price decimal(20,8), low_price decimal(20,8),"
    " close_price decimal(20,8), open_time timestamp_ntz, close_time timestamp_ntz"
)


def test_a_replayed_epoch_changes_nothing_in_the_store(spark, store):
    assert store(_store_batch(spark, 20, 1).repartition(4), 0)
    assert store(_store_batch(spark, 5, 2), 1)
    held = _rows_of(store)
    assert sorted({r[1] for r in held}) == [1, 2] and len(held) == 20
    assert not store(_store_batch(spark, 20, 1), 0)
    assert not store(_store_batch(spark, 5, 3), 1)
    assert _rows_of(store) == held
    assert store(spark.createDataFrame([], _NULLABLE), 2)
    assert _rows_of(store) == held


def test_the_store_moves_a_batch_or_nothing(spark, store, monkeypatch):
    """The driver is lost between upsert and commit; rows staged by lost runs are never moved."""
    assert store(_store_batch(spark, 3, 1), 0)
    held = _rows_of(store)

    def lose(self, *args):
        move(self, *args)
        raise OSError("lost")

    move = BatchStore._move
    with monkeypatch.context() as patch:
        patch.setattr(BatchStore, "_move", lose)
        with pytest.raises(OSError):
            store(_store_batch(spark, 9, 2).repartition(3), 1)
    assert _rows_of(store) == held
    assert len(_rows_of(store, "candle_staging")) == 9
    assert store(_store_batch(spark, 4, 3), 1)
    assert sorted(r[1] for r in _rows_of(store)) == [3, 3, 3, 3]
    assert _rows_of(store, "candle_staging") == []


def test_the_store_keeps_refused_candles_aside(spark, store):
    at = datetime(2021, 1, 1)
    good, bad = ("A", *[Decimal(1)] * 4, at, at), (None, *[Decimal(1)] * 4, at, at)
    assert store(spark.createDataFrame([good, bad], _NULLABLE), 0)
    assert [r[0] for r in _rows_of(store)] == ["A"]
    assert _rows_of(store, "candle_refused", ("epoch", "currency_pair")) == [(0, None)]


def test_staging_makes_no_python_call_for_a_row(spark, store):
    """A task's writing of 5,000 rows, profiled: calls follow batches and columns."""
    rows = _store_batch(spark, 5000, 1).toArrow().to_batches(max_chunksize=2500)
    calls = []

    class Task:
        def taskAttemptId(self):
            return 7

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rowstore.TaskContext, "get", Task)
        write = rowstore._staging(store, "run")
        list(write(iter(rows[:1])))  # imports
        sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
        try:
            (done,) = write(iter(rows))
        finally:
            sys.setprofile(None)
    assert done.to_pylist() == [{"attempt": 7, "candles": 5000}]
    assert len(calls) < 200
    assert len(_rows_of(store, "candle_staging")) == 5000 + rows[0].num_rows


def test_candle_stream_merges_its_epochs(spark, log, batch_candles, tmp_path):
    for chunk in range(6):
        append(log.filter(F.col("offset") % 6 == chunk).coalesce(1), tmp_path)
    mids = decode.mids_from_messages(read_log(spark, FileLog(f"{tmp_path}/log", max_files_per_trigger=1), streaming=True))
    start_candle_stream(
        candle_stream(mids, *DAY), f"{tmp_path}/t", f"{tmp_path}/c", trigger=NOW, state_partitions=2, fanout=2
    ).awaitTermination()
    assert sorted(current_candles(spark, f"{tmp_path}/t").collect()) == sorted(batch_candles)
    assert len({f.split("version=")[1].split("/")[0] for f in current_candles(spark, f"{tmp_path}/t").inputFiles()}) <= 6


def test_pane_stream_merges_its_epochs(spark, log, batch_candles, tmp_path):
    for chunk in range(4):
        append(log.filter(F.col("offset") % 4 == chunk).coalesce(1), tmp_path)
    mids = decode.mids_from_messages(read_log(spark, FileLog(f"{tmp_path}/log", max_files_per_trigger=1), streaming=True))
    start_pane_stream(mids, f"{tmp_path}/t", f"{tmp_path}/c", width="6 hours", trigger=NOW, fanout=2).awaitTermination()
    assert sorted(candles_of_panes(spark, f"{tmp_path}/t", *DAY).collect()) == sorted(batch_candles)


def test_reject_counts_by_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for part in range(2):
        lines = [json.dumps({"u": u, "s": "A", "b": "oops" if u % 5 == part else "1", "a": "2"}) for u in range(10)]
        (raw / f"{part}.json").write_text("\n".join(lines + ['{"u":1,"s":"A","a":"1"}'] * part))
    counts = RejectCounts(f"{tmp_path}/counts")
    spark.streams.addListener(counts)
    try:
        source = read_raw(spark, str(raw), streaming=True, max_files_per_trigger=1)
        query = start_ingest_stream(
            ingest.parse_raw_quotes(source), f"{tmp_path}/log", f"{tmp_path}/c", trigger=NOW
        )
        query.awaitTermination()
        counts.wait_for(query)
    finally:
        spark.streams.removeListener(counts)
    assert sorted(map(repr, counts.of_batches(query).values())) == sorted(
        map(repr, [{"accepted": 8, "non_numeric": 2}, {"accepted": 8, "missing": 1, "non_numeric": 2}])
    )
    assert counts.total() == counts.total(query) == {"accepted": 16, "missing": 1, "non_numeric": 4}
    kept = stored_counts(spark, f"{tmp_path}/counts").groupBy("reason").sum("ticks").collect()
    assert {r[0]: r[1] for r in kept} == counts.total()


def test_delays_of_a_stream(spark, tmp_path):
    """Ticks stamped now and ten minutes ago: delays follow the newest tick of each candle, through the state."""
    at = datetime.now(timezone.utc).replace(tzinfo=None)
    def message(offset, pair, time):
        body = {"bid": "1", "ask": "2", "pair": pair, "timestamp": time.strftime("%Y-%m-%d %H:%M:%S.%f")}
        return (pair, json.dumps(body), 0, offset, time)

    schema = "key string, value string, partition int, offset long, timestamp timestamp_ntz"
    old = at - timedelta(minutes=10)
    spark.createDataFrame([message(0, "A", at), message(1, "B", old)], schema).coalesce(1).write.parquet(f"{tmp_path}/log")
    delays = Delays()

    def run():
        mids = decode.mids_from_messages(read_log(spark, FileLog(f"{tmp_path}/log"), streaming=True))
        changes = candle_stream(mids, "1 hour", "1 hour", newest_tick=True)
        start_candle_stream(
            changes, f"{tmp_path}/t", f"{tmp_path}/c", trigger=NOW, state_partitions=2, delays=delays
        ).awaitTermination()

    run()
    assert delays.batches == 1
    assert 0 < delays.percentile(0.5) < 120 and 600 < delays.percentile(0.99) < 720
    # An older tick changes a candle whose newest tick stays the one it had.
    spark.createDataFrame([message(2, "A", at - timedelta(milliseconds=1))], schema).write.mode("append").parquet(f"{tmp_path}/log")
    run()
    assert current_candles(spark, f"{tmp_path}/t").columns == list(CANDLE_COLUMNS)
    assert current_candles(spark, f"{tmp_path}/t").count() == 2
    if delays.batches == 2:  # the batch may end after the hour and open another candle
        assert delays.percentile(1.0, skip=1) < 180


def test_no_batch_no_delay():
    assert Delays().percentile(0.5) is None


def test_late_ticks_are_kept_beside_a_bounded_state(spark, log, batch_candles, tmp_path):
    """Files in which most ticks come behind the watermark, and a restart between them."""
    parts = 4
    progress = []
    for part in range(parts):
        append(log.filter(F.col("offset") % parts == part).coalesce(1), tmp_path)
        for kind in ("candles", "late"):
            source = FileLog(f"{tmp_path}/log", max_files_per_trigger=1)
            mids = decode.mids_from_messages(read_log(spark, source, streaming=True))
            if kind == "late":
                query = start_late_stream(mids, f"{tmp_path}/late", f"{tmp_path}/c2", "10 minutes", width="6 hours", trigger=NOW)
            else:
                changes = candle_stream(mids, *DAY, watermark="10 minutes", ranks=True)
                query = start_candle_stream(
                    changes, f"{tmp_path}/t", f"{tmp_path}/c1", trigger=NOW, state_partitions=2, upsert=write_ranked_epoch
                )
            query.awaitTermination()
            progress += query.recentProgress if kind == "candles" else []
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress)
    assert dropped > 1000
    # Five pairs, four windows that a time is in, and some more that the watermark has not passed.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 5 * 6
    found = candles_with_late(spark, f"{tmp_path}/t", f"{tmp_path}/late", *DAY)
    assert found.columns == list(CANDLE_COLUMNS)
    assert sorted(map(tuple, found.collect())) == sorted(batch_candles)
    assert len(list((tmp_path / "late" / "_seen").iterdir())) == 1

