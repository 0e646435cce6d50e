"""Every query against its DuckDB SQL, on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from wickframe.plans.oracle import ORACLE
from wickframe.plans.registry import QUERIES

# Known sizes at sf0.01.
ROWS = {
    "raw_quote_parse": 10_000,
    "tick_quality_accept": 9_400,
    "tick_quality_reject": 800,
    "tick_quality_no_timestamp": 200,
    "sliding_window_assign": 49_000,
    "candles_5m_1m": 41_295,
    "candles_5m_1m_clean": 44_781,
    "candles_5m_1m_null_mids": 43_941,
    "candles_1d_6h": 615,
    "candle_stream_late": 615,
    "restart_no_regression": 615,
    "candles_ordered_limit": 30,
    "latest_12_candles": 60,
    "latest_12_disjoint_candles": 60,
}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf_dir, db, name):
    result = QUERIES[name](spark, sf_dir)
    assert differences(result, db, ORACLE[name]) == ""
    if name in ROWS:
        assert db.execute(f"select count(*) from ({ORACLE[name]})").fetchall() == [(ROWS[name],)]


def test_quality_summary_counts(spark, sf_dir):
    def counts(name):
        return {r.reason: r.ticks for r in QUERIES[name](spark, sf_dir).collect()}

    assert counts("tick_quality_summary") == {
        "accepted": 9_200,
        "missing": 200,
        "non_numeric": 400,
        "unrepresentable": 200,
    }
    assert counts("tick_quality_summary_compat") == {
        "accepted": 9_000,
        "missing": 200,
        "non_numeric": 400,
        "unrepresentable": 400,
    }


def test_entry_returns_candles(spark):
    assert entry(spark).columns[0] == "currency_pair"
    assert entry(spark).count() > 0


def test_results_do_not_depend_on_the_session_zone(spark, sf_dir, db):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("candles_5m_1m", "candles_1d_6h", "latest_12_disjoint_candles"):
            assert differences(QUERIES[name](spark, sf_dir), db, ORACLE[name]) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
