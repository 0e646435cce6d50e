"""Messages and price text, case by case."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wickframe.functions.prices import mid_price
from wickframe.operators import decode, ingest
from wickframe.plans.candles import quotes_from_raw
from wickframe.schemas import COMPAT, EXACT

AT = "2021-01-01 23:34:45.000"


def message(bid="1", ask="2", pair="BTCUSDT", timestamp=AT, **extra):
    body = {"bid": bid, "ask": ask, "pair": pair, "timestamp": timestamp, **extra}
    return json.dumps({k: v for k, v in body.items() if v != "absent"})


def mids(spark, mode, *values):
    log = spark.createDataFrame(list(enumerate(values)), "offset long, value string")
    rows = decode.decode_messages(log, mode)
    rows = rows.withColumn("mid_price", mid_price(F.col("bid"), F.col("ask"), mode))
    return rows.orderBy("sequence").collect()


def test_compat_rounds_half_up_to_whole_units_before_the_mid(spark):
    pairs = [("23456.60", "23457.60"), ("0.50", "1.50"), ("2.50", "2.50"), (23456.6, 23457.6)]
    rows = mids(spark, COMPAT, *(message(b, a) for b, a in pairs), message("1e3", "1e3"))
    assert [(int(r.bid), int(r.ask), r.mid_price) for r in rows] == [
        (23457, 23458, 23457.5),
        (1, 2, 1.5),
        (3, 3, 3.0),
        (23457, 23458, 23457.5),
        (1000, 1000, 1000.0),
    ]


def test_exact_keeps_eight_decimals(spark):
    row = mids(spark, EXACT, message("0.00000001", "0.00000002"))[0]
    assert row.mid_price == Decimal("0.00000002")  # 0.000000015 rounded half-up
    row = mids(spark, EXACT, message("99999999999.5", "99999999999.5"))[0]
    assert row.mid_price == Decimal("99999999999.5")


@pytest.mark.parametrize("bad", ["99999999999.5", "nan", " 1.5 ", "1_000"])
def test_unparsable_field_is_null_and_the_rest_is_kept(spark, bad):
    row = mids(spark, COMPAT, message(bid=bad))[0]
    assert (row.bid, int(row.ask), row.pair, row.mid_price) == (None, 2, "BTCUSDT", None)


def test_malformed_and_empty_messages_have_null_fields(spark):
    no_key = '{"bid": "23456.60", "ask": "23457.60", "pair": "BTCUSDT", "2021-01-01 23:34:45.000"}'
    for row in mids(spark, EXACT, no_key, "", None, "[]", "17"):
        assert row.pair is None and row.timestamp is None and row.mid_price is None


def test_missing_time_and_pair_stay_null(spark):
    rows = mids(spark, EXACT, message(timestamp="absent"), message(pair=None))
    assert rows[0].timestamp is None and rows[0].pair == "BTCUSDT"
    assert rows[1].pair is None and rows[1].timestamp == datetime(2021, 1, 1, 23, 34, 45)


def test_time_fractions(spark):
    times = ["2021-01-01 23:34:45.123456", "2021-01-01 23:34:45.123", "2021-01-01 23:34:45"]
    rows = mids(spark, EXACT, *(message(timestamp=t) for t in times))
    assert [r.timestamp.microsecond for r in rows] == [123456, 123000, 0]


# Text and whether the gate takes it for a number.
GATE_CASES = {
    "1.5": True,
    " 1.5 ": True,
    "nan": True,
    "NaN": True,
    "inf": True,
    "-inf": True,
    "Infinity": True,
    "1e5": True,
    "1E-5": True,
    "1.": True,
    ".5": True,
    "+5": True,
    "1_000": True,
    "": False,
    " ": False,
    "abc": False,
    "0x1A": False,
    "0x1p3": False,
    "1,000": False,
    "1.0d": False,
    "1.0f": False,
    "1__0": False,
    "_1": False,
    ".": False,
    "e5": False,
    "1e": False,
    "infin": False,
    "--1": False,
}


def test_gate_takes_what_reads_as_a_float(spark):
    for text, expected in GATE_CASES.items():
        try:
            float(text)
            assert expected, text
        except ValueError:
            assert not expected, text
    rows = spark.createDataFrame([(t,) for t in GATE_CASES], "bid string")
    reason = ingest.quality_reason(F.col("bid"), F.lit("1"))
    judged = rows.select("bid", ingest.passes_gate(reason).alias("passed"))
    found = {r.bid: r.passed for r in judged.collect()}
    assert found == GATE_CASES


def test_reasons(spark):
    cases = [
        (None, "1", "P", AT, "missing"),
        ("1", None, "P", AT, "missing"),
        ("x", "1", "P", AT, "non_numeric"),
        ("1", "nan", "P", AT, "unrepresentable"),
        (" 1.5 ", "1", "P", AT, "unrepresentable"),
        ("1000000000000", "1", "P", AT, "unrepresentable"),
        ("1", "2", "P", None, "no_timestamp"),
        ("1", "2", None, AT, "no_pair"),
        ("1", "2", "P", AT, None),
    ]
    ticks = spark.createDataFrame(
        [c[:4] for c in cases], "bid string, ask string, pair string, timestamp string"
    )
    graded = ingest.grade(ticks.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))
    assert [r.reason for r in graded.collect()] == [c[4] for c in cases]


def test_raw_quotes_with_quantities_and_absent_keys(spark):
    full = {"u": 400900217, "s": "BNBUSDT", "b": "25.35190000", "B": "31.21000000",
            "a": "25.36520000", "A": "40.66000000"}
    bare = {"u": 2, "s": "BNBUSDT", "B": "1", "A": "2"}
    raw = spark.createDataFrame([(json.dumps(full),), (json.dumps(bare),)], "value string")
    rows = ingest.parse_raw_quotes(raw).orderBy(F.desc("sequence")).collect()
    assert (rows[0].sequence, rows[0].pair, rows[0].bid, rows[0].ask) == (
        400900217, "BNBUSDT", "25.35190000", "25.36520000")
    assert rows[0].timestamp is not None  # stamped on arrival
    assert rows[1].bid is None and rows[1].ask is None


def test_pairs_in_any_case(spark):
    quotes = spark.createDataFrame([("BTCUSDT",), ("ethusdt",), ("BNBUSDT",)], "pair string")
    kept = ingest.only_pairs(quotes, ("btcusdt", "ETHUSDT")).collect()
    assert [r.pair for r in kept] == ["BTCUSDT", "ethusdt"]


@pytest.mark.parametrize("more", [(), tuple(f"PAIR{i}" for i in range(20))])
def test_text_test_before_parsing_loses_no_quote(spark, more):
    values = [
        '{"u":1,"s":"BTCUSDT","b":"1","a":"2"}',
        '{"u":2,"s":"btcUSDT","b":"1","a":"2"}',
        '{"u":3,"s":"\\u0042TCUSDT","b":"1","a":"2"}',
        '{"u":4,"s":"ETHUSDT","b":"btcusdt","a":"2"}',
        '{"u":5,"s":"XRPUSDT","b":"1","a":"2"}',
        None,
    ]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    kept = quotes_from_raw(raw, pairs=("BTCUSDT", *more)).collect()
    assert sorted(r.sequence for r in kept) == [1, 2, 3]
    assert ingest.may_mention(raw, ("BTCUSDT", *more)).count() == 4


def test_encoded_message_round_trip(spark):
    ticks = spark.createDataFrame(
        [(7, "BTCUSDT", "1.10", "1.20", datetime(2021, 1, 1, 0, 0, 0, 5))],
        "sequence long, pair string, bid string, ask string, timestamp timestamp_ntz",
    )
    row = ingest.encode_messages(ticks).first()
    assert row.key == "BTCUSDT"
    assert row.value == (
        '{"bid":"1.10","ask":"1.20","pair":"BTCUSDT","timestamp":"2021-01-01 00:00:00.000005"}'
    )


def test_many_pairs_are_looked_up_not_searched(spark):
    """Ten thousand pairs: the plan stays flat and what the text cannot tell is parsed."""
    values = [
        '{"u":1,"s":"BTCUSDT","b":"1","a":"2"}',
        '{"u":2, "s" : "btcUSDT","b":"1","a":"2"}',
        '{"u":3,"s":"\\u0042TCUSDT","b":"1","a":"2"}',
        '{"u":4,"s":"ETHUSDT","b":"btcusdt","a":"2"}',
        '{"u":5,"s":"XRPUSDT","x":{"s":"a"},"b":"1","a":"2"}',
        '{"u":6,"s":77,"b":"1","a":"2"}',
        '{"u":7,"b":"1","a":"2"}',
        "",
        None,
    ]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    pairs = ["BTCUSDT", "77", *(f"pair{i}usdt" for i in range(10_000))]
    kept = quotes_from_raw(raw, pairs=pairs)
    assert sorted(r.sequence for r in kept.collect()) == [1, 2, 3, 6]
    passed = {r.value for r in ingest.may_mention(raw, pairs).collect()}
    assert values[3] not in passed and set(values[:3]) | {values[4], values[5]} <= passed
