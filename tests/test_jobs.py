"""The spark-submit jobs, end to end on files."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest

from wickframe import jobs
from wickframe.streaming.table import candles_of_panes, current_candles


def raw_lines(n):
    for u in range(n):
        price = 100 + (u * 37) % 50
        yield json.dumps({"u": u, "s": ("BTCUSDT", "ETHUSDT", "XRPUSDT")[u % 3],
                          "b": "oops" if u % 10 == 9 else f"{price}.00000000",
                          "B": "1.0", "a": f"{price + 1}.00000000", "A": "2.0"})


def test_jobs(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "quotes.json").write_text("\n".join(raw_lines(90)))
    log, candles, again = (str(tmp_path / p) for p in ("log", "candles", "again"))
    jobs.main(["ingest", "--raw", str(raw), "--log", log, "--pairs", "btcusdt,ethusdt",
               "--checkpoint", str(tmp_path / "c1"), "--once"])
    passed = spark.read.parquet(log).filter("passed = 'true'")
    # u % 30 is 9 or 19 for the faulty quotes of the two pairs, 29 for the third.
    assert passed.count() == 60 - 6

    source = ["--log", log, "--gated"]
    jobs.main(["stream", *source, "--table", candles, "--checkpoint", str(tmp_path / "c2"),
               "--once", "--state-partitions", "2"])
    jobs.main(["backfill", *source, "--table", again])
    streamed = current_candles(spark, candles).collect()
    assert sorted(streamed) == sorted(current_candles(spark, again).collect())
    # All quotes arrived at one time, so each pair has five windows around it.
    assert len(streamed) == 10
    newest = max(r.open_time for r in streamed)
    assert datetime.now() - newest < timedelta(hours=24)
    first = min(streamed, key=lambda r: (r.currency_pair, r.open_time))
    assert first.currency_pair == "BTCUSDT" and float(first.open_price) == 100.5

    jobs.main(["compact", "--table", candles, "--upto-epoch", "0"])
    capsys.readouterr()
    jobs.main(["latest", "--table", candles, "--n", "2"])
    shown = capsys.readouterr().out
    assert shown.count("BTCUSDT") == 2 and shown.count("ETHUSDT") == 2
    jobs.main(["latest", "--table", candles, "--disjoint"])
    assert capsys.readouterr().out.count("BTCUSDT") == 1


def test_pane_jobs(spark, tmp_path, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "quotes.json").write_text("\n".join(raw_lines(90)))
    log, panes, candles = (str(tmp_path / p) for p in ("log", "panes", "candles"))
    jobs.main(["ingest", "--raw", str(raw), "--log", log, "--checkpoint", str(tmp_path / "c1"),
               "--once"])
    jobs.main(["stream", "--panes", "--log", log, "--gated", "--table", panes,
               "--checkpoint", str(tmp_path / "c2"), "--once"])
    jobs.main(["backfill", "--log", log, "--gated", "--table", candles])
    expected = current_candles(spark, candles).collect()
    assert sorted(candles_of_panes(spark, panes).collect()) == sorted(expected)
    jobs.main(["compact", "--panes", "--table", panes, "--upto-epoch", "0"])
    capsys.readouterr()
    jobs.main(["latest", "--panes", "--table", panes, "--n", "1"])
    assert capsys.readouterr().out.count("USDT") == 3


@pytest.mark.parametrize("panes", [False, True])
def test_messages_outside_the_limit_are_kept(spark, tmp_path, panes):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "quotes.json").write_text("\n".join(raw_lines(90)))
    log, candles, again = (str(tmp_path / p) for p in ("log", "candles", "again"))
    jobs.main(["ingest", "--raw", str(raw), "--log", log, "--checkpoint", str(tmp_path / "c1"), "--once"])
    limited = ["--log", log, "--gated", "--sequence-limit", "60"]
    jobs.main(["stream", *(["--panes"] if panes else []), *limited, "--table", candles,
               "--checkpoint", str(tmp_path / "c2"), "--once"])
    jobs.main(["backfill", *limited, "--table", again, "--rejects", str(tmp_path / "kept")])
    streamed = candles_of_panes(spark, candles) if panes else current_candles(spark, candles)
    assert sorted(streamed.collect()) == sorted(current_candles(spark, again).collect())
    wanted = [u for u in range(60, 90) if u % 10 != 9]
    for path, job in ((f"{candles}_rejects", "stream"), (str(tmp_path / "kept"), "backfill")):
        rows = spark.read.parquet(path).orderBy("sequence").collect()
        assert [r.sequence for r in rows] == wanted
        assert {(r.reason, r.job) for r in rows} == {("bad_sequence", job)}
        assert all(json.loads(r.value)["bid"] for r in rows)


def test_kafka_arguments():
    args = jobs.parser().parse_args(
        ["stream", "--servers", "a:1,b:2", "--topic", "ticks", "--table", "t",
         "--checkpoint", "c", "--every", "500 milliseconds"]
    )
    source = jobs._log_source(args)
    assert source.servers == ("a:1", "b:2") and source.topic == "ticks"
    assert jobs._trigger(args) == {"processingTime": "500 milliseconds"}


def test_backfill_from_a_time(spark, tmp_path):
    """A table with wrong candles from a time on is made right by replaying from then."""
    at = datetime(2021, 1, 1)
    rows = [
        ("A", json.dumps({"bid": str(i), "ask": str(i), "pair": "A", "timestamp": str(at + timedelta(minutes=i))}), 0, i, at + timedelta(minutes=i))
        for i in range(60)
    ]
    log = spark.createDataFrame(rows, "key string, value string, partition int, offset long, timestamp timestamp_ntz")
    log.write.parquet(f"{tmp_path}/log")
    log.filter("offset not between 30 and 40").write.parquet(f"{tmp_path}/gap")
    broken, whole = f"{tmp_path}/broken", f"{tmp_path}/whole"
    jobs.main(["backfill", "--log", f"{tmp_path}/gap", "--table", broken])
    jobs.main(["backfill", "--log", f"{tmp_path}/log", "--table", whole])
    assert sorted(current_candles(spark, broken).collect()) != sorted(current_candles(spark, whole).collect())
    jobs.main(["backfill", "--log", f"{tmp_path}/log", "--table", broken, "--from-time", "2021-01-01T00:30"])
    assert sorted(current_candles(spark, broken).collect()) == sorted(current_candles(spark, whole).collect())


def test_a_repeated_backfill_keeps_rejects_once(spark, tmp_path, monkeypatch):
    body = {"bid": "1", "ask": "1", "pair": "A", "timestamp": "2021-01-01 00:00:00"}
    rows = [("A", json.dumps(body), 0, i, datetime(2021, 1, 1)) for i in range(4)]
    log = spark.createDataFrame(rows, "key string, value string, partition int, offset long, timestamp timestamp_ntz")
    log.write.parquet(f"{tmp_path}/log")
    job = ["backfill", "--log", f"{tmp_path}/log", "--table", f"{tmp_path}/t", "--sequence-limit", "2"]

    def lose(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs.table, "write_epoch", lose)
        with pytest.raises(OSError):
            jobs.main(job)
    jobs.main(job)
    assert spark.read.parquet(f"{tmp_path}/t_rejects").count() == 2

