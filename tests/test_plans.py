"""Physical plans keep the shape that scales."""

from __future__ import annotations

import re

import pytest
from plans import plan_text

from wickframe.operators import decode, ingest, ohlc, reads
from wickframe.plans.candles import candles_from_log, candles_from_raw
from wickframe.plans.registry import QUERIES
from wickframe.sources import quotes
from wickframe.sources.ticklog import FileLog, read_log, replay


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "raw")
    quotes.raw_quotes(quotes.events(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def log(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log")
    events = quotes.events(spark, sf_dir)
    quoted = ingest.parse_raw_quotes(quotes.raw_quotes(events), "arrived")
    ingest.gate_log(quoted).filter("passed").drop("reason", "passed").write.parquet(path)
    return read_log(spark, FileLog(path))


def parses(plan):
    return len(re.findall(r"from_json\(", plan))


def test_text_is_parsed_once_whatever_is_filtered(raw, log):
    graded = ingest.grade(ingest.parse_raw_quotes(raw, "arrived"))
    typed = decode.mids_from_messages(log)
    for df in (
        candles_from_raw(raw, "arrived"),
        candles_from_raw(raw, "arrived", pairs=["viewusdt"]),
        ingest.accepted(graded),
        ingest.quarantined(graded),
        candles_from_log(log),
        typed.filter("mid_price > 3 and pair = 'VIEWUSDT'"),
    ):
        assert parses(plan_text(df)) == 1


def test_candles_are_hash_aggregated(raw, log):
    for df in (
        candles_from_raw(raw, "arrived"),
        candles_from_log(log),
        ohlc.candles_direct(decode.mids_from_messages(log)),
        ohlc.candles(decode.mids_from_messages(log), sequence_limit=10**10),
    ):
        plan = plan_text(df)
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_panes_shuffle_twice_and_pre_aggregate_before_each(log):
    plan = plan_text(candles_from_log(log))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_min_by") == 2
    # Ticks are aggregated before windows multiply rows.
    assert plan.count("Generate explode(sequence") == 1
    assert plan.index("Generate explode(sequence") < plan.rindex("partial_min_by")


def test_latest_candles_cut_before_the_shuffle_by_pair(log):
    candles = candles_from_log(log)
    for df in (reads.latest(candles), reads.latest_disjoint(candles)):
        plan = plan_text(df)
        assert re.search(r"WindowGroupLimit .* Partial", plan)
    assert "TakeOrderedAndProject" in plan_text(reads.ordered(candles, 30))


def test_scans_read_needed_columns_and_push_filters(spark, sf_dir, log):
    plan = plan_text(QUERIES["candles_5m_1m_clean"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan
    plan = plan_text(decode.mids_from_messages(replay(log, 2000, 2999, partition=0)))
    assert "GreaterThanOrEqual(offset,2000)" in plan and "EqualTo(partition,0)" in plan
    assert "key" not in plan.split("ReadSchema")[1]


def test_no_query_joins_or_leaves_the_jvm(spark, sf_dir):
    for name, query in QUERIES.items():
        if "stream" in name or "restart" in name or "upsert" in name:
            continue
        plan = plan_text(query(spark, sf_dir))
        assert not re.search(r"Join|Cartesian|Python|Broadcast", plan), name
