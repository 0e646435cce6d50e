"""The candle table: upserts, replays, refused rows, compaction."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from plans import plan_text

from wickframe.operators import contract
from wickframe.schemas import CANDLE_COLUMNS, COMPAT, candle_schema
from wickframe.streaming import table as tables
from wickframe.streaming.table import compact, current_candles, quarantined_candles, write_epoch

START = datetime(2021, 10, 14, 23, 50)


def candle(pair, minute, price, **changes):
    at = START + timedelta(minutes=minute)
    row = dict(zip(CANDLE_COLUMNS, (pair, *[Decimal(price)] * 4, at, at + timedelta(minutes=5))))
    return tuple((row | changes).values())


def frame(spark, rows):
    nullable = candle_schema()
    for field in nullable:
        field.nullable = True
    return spark.createDataFrame(rows, nullable)


def contents(spark, path, **bounds):
    rows = current_candles(spark, path, **bounds).collect()
    assert len({(r.currency_pair, r.open_time) for r in rows}) == len(rows)
    return {(r.currency_pair, r.open_time): int(r.close_price) for r in rows}


def random_epochs(spark, path, epochs=6):
    """Write random changes and return what the table must hold."""
    rng, expected = random.Random(1), {}
    for epoch in range(epochs):
        keys = {(rng.choice("AB"), rng.randint(0, 30)) for _ in range(25)}
        rows = [candle(pair, minute, epoch * 100 + minute) for pair, minute in keys]
        write_epoch(frame(spark, rows), path, epoch)
        expected |= {(r[0], r[5]): int(r[4]) for r in rows}
    return expected


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


def test_last_write_wins_across_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    expected = random_epochs(spark, path)
    assert contents(spark, path) == expected


def test_replaying_an_epoch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("A", 0, 1), candle("A", 1, 1)]), path, 0)
    for _ in range(2):
        write_epoch(frame(spark, [candle("A", 1, 2), candle("B", 20, 2)]), path, 1)
        keyed = {k[0] + str(k[1].minute): v for k, v in contents(spark, path).items()}
        assert keyed == {"A50": 1, "A51": 2, "B10": 2}
    write_epoch(frame(spark, [candle("A", 0, 1), candle("A", 1, 1)]), path, 0)
    assert contents(spark, path)[("A", START + timedelta(minutes=1))] == 2


def test_one_file_per_date_and_epoch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [candle(f"P{i}", m, 1) for i in range(20) for m in (0, 30)]
    write_epoch(frame(spark, rows).repartition(8), path, 0)
    assert len(files(path)) == 2
    merged = contents(spark, path)
    write_epoch(frame(spark, rows).repartition(8), path, 0, merge_files=False)
    assert len(files(path)) > 2
    assert contents(spark, path) == merged


def test_empty_epoch(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("A", 0, 1)]), path, 0)
    write_epoch(frame(spark, []), path, 1)
    assert len(contents(spark, path)) == 1


def test_date_bounds_prune_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("A", 0, 1), candle("A", 30, 2)]), path, 0)
    assert list(contents(spark, path, since=date(2021, 10, 15)).values()) == [2]
    assert list(contents(spark, path, until=date(2021, 10, 14)).values()) == [1]
    bounded = current_candles(spark, path, since=date(2021, 10, 15))
    scan = next(line for line in plan_text(bounded).splitlines() if "FileScan" in line)
    partition_filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "valid" in partition_filters and "open_date" in partition_filters


def test_refused_rows_are_kept_aside(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [candle("A", 0, 1), candle(None, 0, 1), candle("A", 1, 1, open_price=None),
            candle("A", 2, 1, open_time=None)]
    for _ in range(2):
        write_epoch(frame(spark, rows), path, 3)
        assert len(contents(spark, path)) == 1
        assert quarantined_candles(spark, path).count() == 3
    assert contract.not_null_violations(frame(spark, rows)).first().violations == 3
    assert contract.not_null_violations(current_candles(spark, path)).first().violations == 0


def test_table_of_double_prices(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("A", *[1.5] * 4, START, START)], candle_schema(COMPAT))
    write_epoch(rows, path, 0)
    assert current_candles(spark, path, COMPAT).collect() == rows.collect()


def test_unique_violations(spark):
    rows = [candle("A", 0, 1), candle("A", 0, 2), candle("B", 0, 1)]
    assert contract.unique_violations(frame(spark, rows)).first().violations == 1


def versions(path):
    return sorted({int(f.split("version=")[1].split("/")[0]) for f in files(path)})


def test_compaction_keeps_rows_and_removes_old_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    expected = random_epochs(spark, path)
    assert compact(spark, path, upto_epoch=4) == [date(2021, 10, 14), date(2021, 10, 15)]
    assert contents(spark, path) == expected
    assert versions(path) == [9, 10]
    # Nothing is left to merge before epoch 4, and later epochs win over the merged version.
    assert compact(spark, path, upto_epoch=4) == []
    write_epoch(frame(spark, [candle("A", 0, 999)]), path, 6)
    expected[("A", START)] = 999
    assert contents(spark, path) == expected
    compact(spark, path, upto_epoch=6)
    assert contents(spark, path) == expected
    assert versions(path) == [13]


def test_compaction_rewrites_only_touched_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    expected = random_epochs(spark, path, epochs=2)
    compact(spark, path, upto_epoch=1)
    write_epoch(frame(spark, [candle("A", 0, 999), candle(None, 3, 1)]), path, 2)
    expected[("A", START)] = 999
    assert compact(spark, path, upto_epoch=2) == [date(2021, 10, 14)]
    assert contents(spark, path) == expected
    assert quarantined_candles(spark, path).count() == 1
    kept = {f.rsplit("/", 1)[0] for f in files(path)}
    assert kept == {
        "version=3/valid=true/open_date=2021-10-15",
        "version=5/valid=true/open_date=2021-10-14",
        "version=4/valid=false/open_date=2021-10-14",
    }


@pytest.mark.parametrize("removals", [0, 1, 3])
@pytest.mark.parametrize("next_epoch", [5, 6])
def test_compaction_that_is_lost_during_the_removal(
    spark, tmp_path, monkeypatch, removals, next_epoch
):
    path = str(tmp_path / "t")
    expected = random_epochs(spark, path)
    delete, done = tables.paths.delete, []

    def lose(session, folder):
        if len(done) == removals:
            raise OSError("lost")
        done.append(folder)
        delete(session, folder)

    with monkeypatch.context() as patch:
        patch.setattr(tables.paths, "delete", lose)
        with pytest.raises(OSError):
            compact(spark, path, upto_epoch=5)
    assert contents(spark, path) == expected
    if next_epoch == 6:
        write_epoch(frame(spark, [candle("B", 1, 999)]), path, 6)
        expected[("B", START + timedelta(minutes=1))] = 999
    compact(spark, path, upto_epoch=next_epoch)
    assert contents(spark, path) == expected
    assert versions(path) == [2 * next_epoch + 1]


def test_compaction_ahead_of_the_stream_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("A", 0, 1)]), path, 0)
    compact(spark, path, upto_epoch=10)
    write_epoch(frame(spark, [candle("A", 0, 2), candle("A", 1, 2)]), path, 1)
    assert sorted(contents(spark, path).values()) == [2, 2]
    compact(spark, path, upto_epoch=10)
    assert sorted(contents(spark, path).values()) == [2, 2]


def test_compaction_needs_no_mark_of_the_committer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    expected = random_epochs(spark, path)
    delete = tables.paths.delete

    def lose_second(session, folder, done=[]):  # noqa: B006
        if done:
            raise OSError("lost")
        done.append(folder)
        delete(session, folder)

    with monkeypatch.context() as patch:
        patch.setattr(tables.paths, "delete", lose_second)
        with pytest.raises(OSError):
            compact(spark, path)
    delete(spark, f"{path}/version=11/_SUCCESS")
    compact(spark, path)
    assert contents(spark, path) == expected


def test_backfill_replaces_no_epoch(spark, tmp_path):
    path = str(tmp_path / "t")
    write_epoch(frame(spark, [candle("B", 0, 1)]), path, 0)
    assert tables.write_backfill(frame(spark, [candle("A", 0, 2)]), path) == 1
    assert sorted(contents(spark, path).values()) == [1, 2]
    compact(spark, path)
    assert tables.write_backfill(frame(spark, [candle("A", 0, 3)]), path) == 2
    assert sorted(contents(spark, path).values()) == [1, 3]


def test_table_knows_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("A", *[1.5] * 4, START, START)], candle_schema(COMPAT))
    write_epoch(rows, path, 0)
    assert current_candles(spark, path).collect() == rows.collect()
    with pytest.raises(ValueError, match="holds candles-double"):
        write_epoch(frame(spark, [candle("A", 0, 1)]), path, 1)
    with pytest.raises(ValueError, match="holds candles-double"):
        tables.current_panes(spark, path)
