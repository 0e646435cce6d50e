"""Merges by size, delayed removal, and reads of the newest dates."""

from __future__ import annotations

import re
from datetime import date, timedelta
from pathlib import Path

import pytest
from test_table import START, candle, contents, frame

from wickframe.operators import reads
from wickframe.streaming import paths
from wickframe.streaming import table as tables
from wickframe.streaming.table import (
    compact,
    current_candles,
    latest_candles,
    merge_by_size,
    quarantined_candles,
    write_epoch,
)
from wickframe.streaming.upkeep import WHOLE, Merge, due, live, merges, stored_versions


def counted(spark, path):
    return live(stored_versions(spark, path), merges(spark, path))


def test_versions_stay_bounded_over_a_thousand_epochs():
    versions, level, widest = [], {}, 0
    rewritten = 0
    held = {}
    for epoch in range(1000):
        versions.append(2 * epoch)
        held[2 * epoch] = 1
        found = due(versions, level, 8)
        if found:
            sources, at = found
            assert sources == versions[-len(sources) :]
            level[2 * epoch + 1] = at
            held[2 * epoch + 1] = sum(held[v] for v in sources)
            rewritten += held[2 * epoch + 1]
            versions = [*versions[: -len(sources)], 2 * epoch + 1]
        widest = max(widest, len(versions))
    assert sum(held[v] for v in versions) == 1000
    assert widest <= 8 * 4
    assert rewritten <= 4 * 1000


def test_folders_read_stay_bounded_over_a_thousand_epochs(spark, tmp_path, monkeypatch):
    """The marks and folders of a thousand epochs, with writes that only leave the folder."""
    path, read, kept = str(tmp_path / "t"), 0, 0

    def leave(rows, layout, path, version, merge_files=True):
        paths.mark(spark, f"{path}/version={version}/valid=true/open_date=2021-10-14")

    monkeypatch.setattr(tables, "_write", leave)
    monkeypatch.setattr(tables, "_stored", lambda *args, **options: frame(spark, []).selectExpr("*", "true as valid", "0L as version"))
    clock = iter(range(10**9))
    monkeypatch.setattr(tables, "_millis", lambda: next(clock) * 1000)
    for epoch in range(1000):
        leave(None, None, path, 2 * epoch)
        merge_by_size(spark, path, tables.candle_layout(), fanout=8, keep_for=20)
        read = max(read, len(counted(spark, path)))
        kept = max(kept, len(stored_versions(spark, path)))
    assert read <= 8 * 4
    # Merged versions wait for a while, here some epochs, before they go.
    assert kept <= 8 * 4 + 2 * 40
    assert len(paths.children(spark, f"{path}/_merged")) <= 8 * 4 + 40


def epochs_by_size(spark, path, epochs, **options):
    expected = {}
    for epoch in range(epochs):
        rows = [candle("A", (7 * epoch + k) % 40, 100 * epoch + k) for k in range(3)]
        rows.append(candle(None, epoch, 1))  # refused
        write_epoch(frame(spark, rows), path, epoch)
        expected |= {(r[0], r[5]): int(r[4]) for r in rows if r[0]}
        merge_by_size(spark, path, **options)
        if epoch % 5 == 4:
            assert contents(spark, path) == expected
    return expected


@pytest.mark.parametrize("keep_for", [0, 3600])
def test_merges_by_size_keep_all_rows(spark, tmp_path, keep_for):
    path = str(tmp_path / "t")
    expected = epochs_by_size(spark, path, 14, fanout=3, keep_for=keep_for)
    assert contents(spark, path) == expected
    assert quarantined_candles(spark, path).count() == 14
    assert len(counted(spark, path)) <= 2 * 3
    compact(spark, path)
    assert contents(spark, path) == expected
    write_epoch(frame(spark, [candle("A", 0, 7)]), path, 14)
    expected["A", START] = 7
    compact(spark, path)
    assert contents(spark, path) == expected
    assert counted(spark, path) == [27, 29]  # the first merge has a date the second did not touch
    assert quarantined_candles(spark, path).count() == 14


def test_a_reader_planned_before_a_merge_still_answers(spark, tmp_path):
    path = str(tmp_path / "t")
    epochs_by_size(spark, path, 2, fanout=3)
    planned = current_candles(spark, path)
    files = set(planned.inputFiles())
    expected = {(r.currency_pair, r.open_time, r.close_price) for r in current_candles(spark, path).collect()}
    for epoch in range(2, 12):
        write_epoch(frame(spark, [candle("B", epoch, epoch)]), path, epoch)
        merge_by_size(spark, path, fanout=3, keep_for=3600)
    assert {(r.currency_pair, r.open_time, r.close_price) for r in planned.collect()} == expected
    assert not files & set(current_candles(spark, path).inputFiles())
    # When the time is over, the files go; new readers did not need them.
    before = contents(spark, path)
    write_epoch(frame(spark, [candle("B", 2, 2)]), path, 12)
    merge_by_size(spark, path, fanout=3, keep_for=0)
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)
    assert contents(spark, path) == before


def test_compaction_can_leave_readers_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("A", 0, 1)]), path, 0)
    planned = current_candles(spark, path)
    write_epoch(frame(spark, [candle("A", 0, 2)]), path, 1)
    assert compact(spark, path, keep_for=3600) == [date(2021, 10, 14)]
    assert planned.first().close_price == 1
    assert list(contents(spark, path).values()) == [2] and counted(spark, path) == [3]
    write_epoch(frame(spark, [candle("A", 1, 3)]), path, 2)
    assert compact(spark, path, keep_for=0) == [date(2021, 10, 14)]
    assert stored_versions(spark, path) == [3, 5] and sorted(contents(spark, path).values()) == [2, 3]


@pytest.mark.parametrize("lost", ["write", "mark", "removal"])
def test_a_lost_merge_by_size_is_made_good(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "t")
    expected = {}
    for epoch in range(3):
        rows = [candle("A", epoch + k, 10 * epoch + k) for k in range(4)]
        write_epoch(frame(spark, rows), path, epoch)
        expected |= {(r[0], r[5]): int(r[4]) for r in rows}

    def lose(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if lost == "removal":
            patch.setattr(paths, "delete", lose)
        else:
            patch.setattr(tables, "_write" if lost == "write" else "complete", lose)
        with pytest.raises(OSError):
            merge_by_size(spark, path, fanout=3, keep_for=0)
    assert contents(spark, path) == expected
    write_epoch(frame(spark, [candle("A", 3, 99)]), path, 3)
    expected["A", START + timedelta(minutes=3)] = 99
    merge_by_size(spark, path, fanout=3, keep_for=0)
    assert contents(spark, path) == expected
    assert len(counted(spark, path)) <= 3


def test_marks_of_earlier_tables_are_understood(spark, tmp_path):
    path = str(tmp_path / "t")
    for epoch in range(3):
        write_epoch(frame(spark, [candle("A", epoch, epoch)]), path, epoch)
    compact(spark, path, 1)
    (mark,) = paths.children(spark, f"{path}/_merged")
    paths.delete(spark, f"{path}/_merged/{mark}")
    paths.mark(spark, f"{path}/_merged/3")
    assert merges(spark, path) == [Merge(3, 0, WHOLE, 0)]
    assert sorted(contents(spark, path).values()) == [0, 1, 2]
    assert counted(spark, path) == [3, 4]


def days_of_history(spark, path, days, pairs="AB"):
    rows = [candle(pair, 1440 * day + minute, day) for day in range(days) for minute in (0, 1) for pair in pairs]
    write_epoch(frame(spark, rows), path, 0)
    return frame(spark, rows)


def dates_read(rows):
    return {re.search(r"open_date=([0-9-]+)", f)[1] for f in rows.inputFiles()}


def test_dates_read_do_not_grow_with_history(spark, tmp_path):
    read = []
    for days in (20, 120):
        path = str(tmp_path / str(days))
        rows = days_of_history(spark, path, days)
        found = latest_candles(spark, path, 12)
        assert sorted(found.collect()) == sorted(reads.latest(rows, 12).collect())
        read.append(len(dates_read(found)))
    assert read[0] == read[1] < 20


def test_reads_widen_for_pairs_with_few_candles(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [candle("dense", 1440 * day + m, day) for day in range(30) for m in range(20)]
    rows += [candle("thin", 1440 * day, day) for day in range(1, 30, 2)]
    rows += [candle("gone", 1440 * day + m, day) for day in range(10) for m in range(20)]
    write_epoch(frame(spark, rows), path, 0)
    found = latest_candles(spark, path, 12)
    expected = [r for r in reads.latest(frame(spark, rows), 12).collect() if r.currency_pair != "gone"]
    assert sorted(found.collect()) == sorted(expected)
    assert len(dates_read(latest_candles(spark, path, 3))) < len(dates_read(found)) <= 30
    every = latest_candles(spark, path, 12, live_days=100)
    assert sorted(every.collect()) == sorted(reads.latest(frame(spark, rows), 12).collect())


def test_latest_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, []), path, 0)
    assert latest_candles(spark, path).collect() == []


def test_latest_disjoint_of_a_merged_table(spark, tmp_path):
    path = str(tmp_path / "t")
    epochs_by_size(spark, path, 10, fanout=3, keep_for=3600)
    found = latest_candles(spark, path, 4, reads.latest_disjoint)
    assert sorted(found.collect()) == sorted(reads.latest_disjoint(current_candles(spark, path), 4).collect())
