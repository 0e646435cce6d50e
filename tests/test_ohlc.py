"""Candles against a brute-force reading of the definition."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from plans import rows_by_operator
from pyspark.sql import functions as F

from wickframe.functions.durations import micros, pane_micros
from wickframe.operators import decode, ohlc, reads
from wickframe.plans import registry
from wickframe.sources import quotes

EPOCH = datetime(1970, 1, 1)
MICRO = timedelta(microseconds=1)


def make_ticks(seed: int, n: int = 3000):
    """Out-of-order ticks with equal times, gaps, NULL mids, and one pair with most rows."""
    rng = random.Random(seed)
    rows = []
    for sequence in rng.sample(range(10 * n), n):
        pair = rng.choices(["HOT", "A", "B", None], [6, 2, 1, 1])[0]
        second = rng.choice([0, 7, 60, 61, 3599.5]) + rng.randint(0, 40) * 60
        at = datetime(2021, 10, 14, 18, 50) + timedelta(seconds=second)
        at = None if rng.random() < 0.05 else at
        mid = None if rng.random() < 0.1 else Decimal(rng.randint(1, 500)) / 4
        rows.append((pair, at, sequence, mid))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "pair string, timestamp timestamp_ntz, sequence long, mid_price decimal(20,8)"
    )


def brute(rows, size, slide, keep_null_mids=False):
    size, slide = (timedelta(microseconds=micros(x)) for x in (size, slide))
    groups = {}
    for pair, at, sequence, mid in rows:
        if at is None or ((mid is None or pair is None) and not keep_null_mids):
            continue
        start = EPOCH + ((at - EPOCH) // slide) * slide
        while start > at - size:
            groups.setdefault((pair, start), []).append((at, sequence, mid))
            start -= slide
    out = set()
    for (pair, start), ticks in groups.items():
        ticks.sort(key=lambda t: t[:2])
        known = [t[2] for t in ticks if t[2] is not None]
        out.add(
            (pair, ticks[0][2], max(known, default=None), min(known, default=None), ticks[-1][2],
             start, start + size)
        )
    return out


def collected(candles):
    rows = candles.collect()
    assert len({(r[0], r[5]) for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("keep_null_mids", [False, True])
@pytest.mark.parametrize(
    "size, slide",
    [("5 minutes", "1 minute"), ("1 hour", "1 hour"), ("6 minutes", "4 minutes"), ("1 day", "6 hours")],
)
def test_candles_match_brute_force(spark, size, slide, keep_null_mids):
    rows = make_ticks(seed=len(size) + keep_null_mids)
    ticks = frame(spark, rows).repartition(7)
    expected = brute(rows, size, slide, keep_null_mids)
    for limit in (None, 30_000, 10**13):
        options = {"sequence_limit": limit, "keep_null_mids": keep_null_mids}
        assert collected(ohlc.candles(ticks, size, slide, **options)) == expected
        assert collected(ohlc.candles_direct(ticks, size, slide, **options)) == expected


@pytest.mark.parametrize("size, slide", [("5 minutes", "1 minute"), ("1 day", "6 hours")])
def test_pane_parts_merge_to_the_same_candles(spark, size, slide):
    rows = make_ticks(seed=11)
    ticks = frame(spark, rows).repartition(5)
    parts = ohlc.partial_panes(ticks.filter("sequence % 3 = 0"))
    for left, limit in ((1, 30_000), (2, 10**13)):
        more = ohlc.partial_panes(ticks.filter(f"sequence % 3 = {left}"), sequence_limit=limit)
        assert more.schema == parts.schema
        parts = parts.unionAll(more)
    expected = brute(rows, size, slide)
    assert collected(ohlc.roll_up(ohlc.merge_panes(parts), size, slide)) == expected
    twice = ohlc.merge_panes(ohlc.merge_panes(parts).unionAll(parts))
    assert collected(ohlc.roll_up(twice, size, slide)) == expected


def test_equal_times_are_ordered_by_sequence(spark):
    at = datetime(2021, 10, 14, 18, 58)
    prices = {5: 50, 10**12: 70, 3: 30, 9: 90}
    rows = [("P", at, sequence, Decimal(price)) for sequence, price in prices.items()]
    candle = ohlc.candles(frame(spark, rows)).first()
    assert (candle.open_price, candle.close_price) == (30, 70)


def test_any_sequence_is_ordered(spark):
    at = datetime(2021, 10, 14, 18, 58)
    prices = {-(2**63): 10, -1: 20, 0: 30, 10**13: 40, 2**63 - 1: 50}
    rows = [("P", at, sequence, Decimal(price)) for sequence, price in prices.items()]
    for df in (frame(spark, rows), frame(spark, rows[::-1])):
        candle = ohlc.candles(df).first()
        assert (candle.open_price, candle.close_price) == (10, 50)
        candle = ohlc.roll_up(ohlc.merge_panes(ohlc.partial_panes(df))).first()
        assert (candle.open_price, candle.close_price) == (10, 50)


def test_sequences_past_bigint_are_ordered(spark):
    at = datetime(2021, 10, 14, 18, 58)
    prices = {-(10**33): 10, -(2**63) - 1: 20, 0: 30, 2**63: 40, 10**33: 50, 10**33 + 1: 60}
    schema = "pair string, timestamp timestamp_ntz, sequence decimal(34,0), mid_price decimal(20,8)"
    rows = [("P", at, Decimal(sequence), Decimal(price)) for sequence, price in prices.items()]
    for some in (rows, rows[::-1]):
        candle = ohlc.candles(spark.createDataFrame([*some, ("P", at, None, None)], schema)).first()
        assert (candle.open_price, candle.close_price) == (10, 60)
    later = ("P", at + MICRO, None, Decimal(70))
    assert ohlc.candles(spark.createDataFrame([later, *rows], schema)).first().close_price == 70


def test_any_sequence_query_takes_every_event_id(spark, tmp_path):
    """Ids whose product with 10**13 is past BIGINT, tied by the minute."""
    rng, at = random.Random(5), datetime(2024, 1, 3, 7)
    ids = [0, 1, 922_336, 922_337, 922_339, 922_342, 5_999_998, 5_999_999, 2**63 - 1, 2**63 - 4, -(2**63), None]
    ids += rng.sample(range(2 * 10**6, 6 * 10**6), 60)
    rows = []
    for event_id in ids:
        time = at + timedelta(seconds=rng.randint(0, 119), hours=6 * rng.randint(0, 4))
        rows.append((event_id, time, rng.choice(["a", "b"]), float(rng.randint(1, 10**6))))
    frame_of = "event_id long, ts timestamp_ntz, event_type string, value double"
    spark.createDataFrame(rows, frame_of).write.parquet(f"{tmp_path}/events.parquet")

    def spread(n):
        n = 0 if n is None else n
        rest = abs(n) % 3 * (1 if n > 0 else -1)
        return -n if rest == 0 else n * 10**13 if rest == 1 else n

    ticks = [(p, t.replace(second=0), spread(n), Decimal(str(v + 0.25))) for n, t, p, v in rows]
    found = registry.candles_any_sequence(spark, str(tmp_path))
    assert collected(found) == brute(ticks, *registry.DAY)


@pytest.mark.parametrize("limit", [100, 10**13])
@pytest.mark.parametrize("past", [-1, None])
def test_sequence_outside_a_limit_is_skipped(spark, limit, past):
    at = datetime(2021, 1, 1)
    outside = limit if past is None else past
    rows = [("P", at, outside, Decimal(7)), ("P", at, limit - 1, Decimal(1))]
    for candle in ohlc.candles(frame(spark, rows), sequence_limit=limit).collect():
        assert (candle.open_price, candle.close_price) == (1, 1)


@pytest.mark.parametrize("limit", [100, 10**13])
def test_sequence_outside_a_limit_counts_for_no_price(spark, limit):
    at = datetime(2021, 1, 1)
    inside = [("P", at, limit - 2, Decimal(2)), ("P", at, limit - 1, Decimal(1))]
    outside = [("P", at, -1, Decimal(7)), ("P", at, limit, Decimal("0.5")), ("Q", at, limit, Decimal(3))]
    ticks = frame(spark, inside + outside)
    for candles in (
        ohlc.candles(ticks, sequence_limit=limit),
        ohlc.candles_direct(ticks, sequence_limit=limit),
        ohlc.roll_up(ohlc.merge_panes(ohlc.partial_panes(ticks, sequence_limit=limit))),
    ):
        rows = candles.collect()
        assert len(rows) == 5 and {r.currency_pair for r in rows} == {"P"}
        for r in rows:
            assert (r.open_price, r.high_price, r.low_price, r.close_price) == (2, 2, 1, 1)


def test_ticks_without_a_pair_make_no_candle(spark):
    rows = [(None, datetime(2021, 1, 1), 1, Decimal(1))]
    for make in (ohlc.candles, ohlc.candles_direct, ohlc.partial_panes):
        assert make(frame(spark, rows)).collect() == []
    assert ohlc.candles(frame(spark, rows), keep_null_mids=True).count() == 5


@pytest.mark.parametrize("sizes", [("5 minutes", "8 minutes"), ("9 minutes", "30 days")])
def test_plan_of_a_roll_up_does_not_grow_with_the_window(spark, sizes):
    panes = ohlc.panes(frame(spark, make_ticks(seed=3)), "1 minute", "1 minute")
    plans = [
        ohlc.roll_up(panes, size, "1 minute")._jdf.queryExecution().executedPlan().toString()
        for size in sizes
    ]
    assert abs(len(plans[0]) - len(plans[1])) < 100


def test_window_bounds_of_a_tick_on_the_minute(spark):
    ticks = frame(spark, [("P", datetime(2021, 10, 14, 18, 58), 1, Decimal(1))])
    rows = ohlc.window_bounds(ohlc.assign_windows(ticks)).orderBy("open_time").collect()
    assert [(r.open_time.minute, r.close_time.minute) for r in rows] == [
        (54, 59), (55, 0), (56, 1), (57, 2), (58, 3)]


def test_zones_with_clock_changes_are_refused(spark):
    ticks = frame(spark, [("P", datetime(2021, 1, 1), 1, Decimal(1))])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ohlc.candles(ticks)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pane_width():
    assert pane_micros("5 minutes", "1 minute") == 60_000_000
    assert pane_micros("6 minutes", "4 minutes") == 120_000_000
    assert micros("1 day 6 hours") == 30 * 3_600_000_000
    for bad in ("", "5", "0 minutes", "1 month", "minutes 5", "1 minute x"):
        with pytest.raises(ValueError):
            micros(bad)


def test_candle_invariants(spark, sf_dir):
    mids = decode.with_mid(quotes.clean_ticks(quotes.events(spark, sf_dir)))
    candles = ohlc.candles(mids, "1 day", "6 hours")
    broken = candles.filter(
        (F.col("low_price") > F.least("open_price", "close_price"))
        | (F.col("high_price") < F.greatest("open_price", "close_price"))
        | (F.col("close_time") != F.col("open_time") + F.expr("interval 1 day"))
    )
    assert broken.count() == 0
    assert candles.filter("open_price <> close_price").count() > 0
    assert ohlc.assign_windows(mids).count() == 5 * mids.count()


def test_latest_disjoint_against_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2021, 1, 1)
    rows = []
    for pair in "AB":
        for minute in sorted(rng.sample(range(400), 150)):
            at = start + timedelta(minutes=minute)
            rows.append((pair, *[Decimal(minute)] * 4, at, at + timedelta(minutes=5)))
    candles = spark.createDataFrame(
        rows,
        "currency_pair string, open_price decimal(20,8), high_price decimal(20,8),"
        " low_price decimal(20,8), close_price decimal(20,8),"
        " open_time timestamp_ntz, close_time timestamp_ntz",
    )
    expected_latest, expected_tiled = set(), set()
    for pair in "AB":
        times = sorted((r[5] for r in rows if r[0] == pair), reverse=True)
        expected_latest |= {(pair, t) for t in times[:12]}
        tiled = [t for t in times if (times[0] - t) % timedelta(minutes=5) == timedelta(0)]
        expected_tiled |= {(pair, t) for t in tiled[:12]}
    key = ("currency_pair", "open_time")
    assert {tuple(r) for r in reads.latest(candles).select(*key).collect()} == expected_latest
    assert {tuple(r) for r in reads.latest_disjoint(candles).select(*key).collect()} == expected_tiled
    assert reads.latest_disjoint(candles).columns == candles.columns


@pytest.mark.parametrize("keep_null_mids", [False, True])
@pytest.mark.parametrize(
    "size, slide", [("1 hour", "1 minute"), ("90 minutes", "7 minutes"), ("1 hour", "5 seconds"), ("50 minutes", "3 minutes")]
)
def test_swept_windows_match_brute_force(spark, size, slide, keep_null_mids):
    rows = make_ticks(seed=len(size + slide), n=400)
    # Ticks on both sides of the epoch, at edges of blocks, and far from all others.
    for sequence, at in enumerate([EPOCH, EPOCH - MICRO, EPOCH - timedelta(hours=1), datetime(1969, 12, 1, 5), datetime(2022, 1, 1)]):
        rows.append(("edge", at, sequence, Decimal(sequence)))
    ticks = frame(spark, rows).repartition(5)
    assert collected(ohlc.candles(ticks, size, slide, keep_null_mids=keep_null_mids)) == brute(rows, size, slide, keep_null_mids)


@pytest.mark.parametrize("size, slide", [("1 day", "6 hours"), ("5 minutes", "1 minute"), ("6 minutes", "4 minutes")])
def test_sweep_and_copies_agree(spark, monkeypatch, size, slide):
    ticks = frame(spark, make_ticks(seed=3, n=800))
    copied = collected(ohlc.candles(ticks, size, slide))
    monkeypatch.setattr(ohlc, "COPIES", 1)
    assert collected(ohlc.candles(ticks, size, slide)) == copied


@pytest.mark.parametrize("minutes", [1, 40])
def test_rows_of_a_sweep_do_not_follow_the_overlap(spark, minutes):
    """A day each minute: between the operators there are at most three rows a pane, and the candles."""
    rows = [("A", datetime(2021, 10, 14) + timedelta(minutes=minutes * i), i, Decimal(i)) for i in range(900)]
    ticks = frame(spark, rows)
    panes = ohlc.panes(ticks, "1 day", "1 minute").persist()
    found = ohlc.roll_up(panes, "1 day", "1 minute")
    candles = found.count()
    counts = rows_by_operator(found)
    assert candles in counts
    assert max(counts) <= candles
    assert sorted(n for n in counts if n != candles)[-1] <= 3 * panes.count()
