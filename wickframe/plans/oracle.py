"""DuckDB SQL with the same results as the queries of ``plans.registry``."""

from __future__ import annotations

# Inputs. They restate sources.quotes in SQL.

_RAW = """
raw AS (
  SELECT event_id, ts,
         '{"u":' || event_id || ',"s":"' || upper(event_type) || 'USDT"'
         || CASE event_id % 50
              WHEN 0 THEN ''
              WHEN 1 THEN ',"b":"abc"'
              WHEN 2 THEN ',"b":"nan"'
              WHEN 3 THEN ',"b":""'
              WHEN 4 THEN ',"b":"99999999999.5"'
              ELSE ',"b":"' || printf('%.8f', value) || '"' END
         || ',"a":"' || printf('%.8f', value + 0.5) || '"}' AS value
  FROM events),
quote AS (
  SELECT CAST(value->>'$.u' AS BIGINT) AS sequence, value->>'$.s' AS pair,
         value->>'$.b' AS bid, value->>'$.a' AS ask, ts AS "timestamp"
  FROM raw)"""


def _graded(price: str) -> str:
    return f"""{_RAW},
graded AS (
  SELECT *, CASE
      WHEN bid IS NULL OR ask IS NULL THEN 'missing'
      WHEN try_cast(bid AS DOUBLE) IS NULL OR try_cast(ask AS DOUBLE) IS NULL THEN 'non_numeric'
      WHEN try_cast(bid AS {price}) IS NULL OR try_cast(ask AS {price}) IS NULL
        THEN 'unrepresentable' END AS reason
  FROM quote)"""


_EXACT_PRICE = "DECIMAL(20,8)"
_COMPAT_PRICE = "DECIMAL(10,0)"

_MESSAGE = f"""{_graded(_EXACT_PRICE)},
message AS (
  SELECT pair AS key, sequence, "timestamp",
         '{{"bid":"' || bid || '","ask":"' || ask || '","pair":"' || pair || '","timestamp":"'
         || strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') || '"}}' AS value
  FROM graded WHERE reason IS NULL OR reason = 'unrepresentable')"""


def _decoded(price: str) -> str:
    return f"""{_MESSAGE},
tick AS (
  SELECT sequence, try_cast(value->>'$.bid' AS {price}) AS bid,
         try_cast(value->>'$.ask' AS {price}) AS ask, value->>'$.pair' AS pair,
         CAST(value->>'$.timestamp' AS TIMESTAMP) AS "timestamp"
  FROM message)"""


_EXACT_MID = f"CAST((bid + ask) * 0.5 AS {_EXACT_PRICE})"
_COMPAT_MID = "CAST(bid + ask AS DOUBLE) / CAST(2 AS DOUBLE)"


def _mids(ticks: str, mid: str) -> str:
    return f"""{ticks},
mids AS (SELECT pair, "timestamp", sequence, {mid} AS mid_price FROM tick)"""


_EXACT_MIDS = _mids(_decoded(_EXACT_PRICE), _EXACT_MID)
_COMPAT_MIDS = _mids(_decoded(_COMPAT_PRICE), _COMPAT_MID)

_CLEAN_MIDS = _mids(
    f"""
tick AS (
  SELECT event_id AS sequence, event_type AS pair, ts AS "timestamp",
         CAST(value AS {_EXACT_PRICE}) AS bid, CAST(value + 0.5 AS {_EXACT_PRICE}) AS ask
  FROM events)""",
    _EXACT_MID,
)

_NULL_TIME = """
text_tick AS (
  SELECT event_id AS sequence, event_type AS pair,
         CASE WHEN event_id % 50 = 4 THEN '99999999999.5' ELSE printf('%.8f', value) END AS bid,
         printf('%.8f', value + 0.5) AS ask,
         CASE WHEN event_id % 50 <> 5 THEN ts END AS "timestamp"
  FROM events)"""

_NULL_MIDS = _mids(
    f"""{_NULL_TIME},
tick AS (
  SELECT sequence, pair, "timestamp", try_cast(bid AS {_COMPAT_PRICE}) AS bid,
         try_cast(ask AS {_COMPAT_PRICE}) AS ask
  FROM text_tick WHERE "timestamp" IS NOT NULL)""",
    _COMPAT_MID,
)


# Candles.


def _windowed(source: str, slide: str, count: int, keep: str = "") -> str:
    """Each tick in the ``count`` windows it belongs to."""
    return f"""
placed AS (
  SELECT s.*, time_bucket(INTERVAL '{slide}', "timestamp", TIMESTAMP '1970-01-01')
              - k * INTERVAL '{slide}' AS open_time
  FROM {source} s, range(0, {count}) r(k) {keep})"""


_FIVE = ("1 minute", 5, "5 minutes")
_DAY = ("6 hours", 4, "1 day")
_DAY_EACH_MINUTE = ("1 minute", 1440, "1 day")
_NINETY_BY_SEVEN = ("7 minutes", 13, "90 minutes")


def _candles(
    mids: str,
    window: tuple[str, int, str] = _FIVE,
    nulls: bool = False,
    epoch: str = "'all'",
    reached: str = "true",
) -> str:
    slide, count, size = window
    keep = "" if nulls else "WHERE mid_price IS NOT NULL"
    first, last = ("arg_min_null", "arg_max_null") if nulls else ("arg_min", "arg_max")
    return f"""{mids},{_windowed("mids", slide, count, keep)},
candle AS (
  SELECT pair AS currency_pair, {epoch} AS epoch,
         {first}(mid_price, ("timestamp", sequence)) AS open_price,
         max(mid_price) AS high_price, min(mid_price) AS low_price,
         {last}(mid_price, ("timestamp", sequence)) AS close_price,
         open_time, open_time + INTERVAL '{size}' AS close_time
  FROM placed WHERE {reached} GROUP BY pair, open_time, {epoch})"""


def _query(ctes: str, body: str) -> str:
    return f"WITH{ctes}\n{body}"


_CANDLE_COLUMNS = (
    "currency_pair, open_price, high_price, low_price, close_price, open_time, close_time"
)
_TICK_COLUMNS = 'sequence, pair, bid, ask, "timestamp"'
_CLEAN_CANDLES = _candles(_CLEAN_MIDS)
_ALL_CANDLES = f"SELECT {_CANDLE_COLUMNS} FROM candle"
_LOG_ROWS = (
    'SELECT key, value, CAST(0 AS INTEGER) AS "partition", sequence AS "offset", "timestamp"'
    " FROM message"
)
_SUMMARY = "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS ticks FROM graded GROUP BY 1"
_DAY_FROM_LOG = _query(_candles(_EXACT_MIDS, _DAY), _ALL_CANDLES)

# Candles of pairs that have one in the last seven days.
_LIVE_CANDLES = f"""{_CLEAN_CANDLES.replace("candle AS", "any_candle AS")},
candle AS (
  SELECT * FROM (
    SELECT *, max(open_time) OVER (PARTITION BY currency_pair) AS pair_newest,
           max(open_time) OVER () AS table_newest FROM any_candle)
  WHERE CAST(pair_newest AS DATE) > CAST(table_newest AS DATE) - 7)"""


def _latest(candles: str, disjoint: bool = False) -> str:
    tiled = f"""{candles},
tiled AS (
  SELECT * FROM (
    SELECT *, max(open_time) OVER (PARTITION BY currency_pair) AS newest FROM candle)
  WHERE date_diff('minute', open_time, newest) % 5 = 0)"""
    return _query(
        tiled if disjoint else candles,
        f"""SELECT {_CANDLE_COLUMNS} FROM {"tiled" if disjoint else "candle"}
QUALIFY row_number() OVER (PARTITION BY currency_pair ORDER BY open_time DESC) <= 12""",
    )


_UPSERTED = _query(
    _candles(_CLEAN_MIDS, _DAY, epoch="sequence % 4"),
    f"""{_ALL_CANDLES}
QUALIFY row_number() OVER (PARTITION BY currency_pair, open_time ORDER BY epoch DESC) = 1""",
)

# A quarter past ten, three days before the last event.
_FAILURE = "(SELECT date_trunc('day', max(ts) - INTERVAL 3 DAY) + INTERVAL '10 hours 15 minutes' FROM events)"

ORACLE: dict[str, str] = {
    "raw_quote_parse": _query(_RAW, f"SELECT {_TICK_COLUMNS} FROM quote"),
    "raw_pair_subset": _query(
        _RAW, f"SELECT {_TICK_COLUMNS} FROM quote WHERE pair IN ('CLICKUSDT', 'VIEWUSDT')"
    ),
    "tick_quality_reason": _query(
        f"""{_graded(_EXACT_PRICE)}""",
        f"""SELECT sequence, reason AS reason_exact,
       coalesce(reason, CASE WHEN try_cast(bid AS {_COMPAT_PRICE}) IS NULL
         OR try_cast(ask AS {_COMPAT_PRICE}) IS NULL THEN 'unrepresentable' END) AS reason_compat
FROM graded""",
    ),
    "tick_quality_accept": _query(
        _graded(_EXACT_PRICE),
        f"SELECT {_TICK_COLUMNS} FROM graded WHERE reason IS NULL OR reason = 'unrepresentable'",
    ),
    "tick_quality_reject": _query(
        _graded(_EXACT_PRICE), f"SELECT {_TICK_COLUMNS}, reason FROM graded WHERE reason IS NOT NULL"
    ),
    "tick_quality_summary": _query(_graded(_EXACT_PRICE), _SUMMARY),
    "tick_quality_summary_compat": _query(_graded(_COMPAT_PRICE), _SUMMARY),
    "tick_quality_no_timestamp": _query(
        _NULL_TIME,
        f"""SELECT {_TICK_COLUMNS}, 'no_timestamp' AS reason
FROM text_tick WHERE "timestamp" IS NULL""",
    ),
    "tick_message_encode": _query(_MESSAGE, 'SELECT key, value, sequence, "timestamp" FROM message'),
    "tick_message_decode": _query(
        _decoded(_EXACT_PRICE), f"SELECT {_TICK_COLUMNS} FROM tick"
    ),
    "tick_message_decode_compat": _query(
        _decoded(_COMPAT_PRICE), f"SELECT {_TICK_COLUMNS} FROM tick"
    ),
    "mid_price_exact": _query(_EXACT_MIDS, 'SELECT pair, "timestamp", sequence, mid_price FROM mids'),
    "mid_price_compat": _query(
        _COMPAT_MIDS, 'SELECT pair, "timestamp", sequence, mid_price FROM mids'
    ),
    "replay_offset_range": _query(
        _MESSAGE,
        f"{_LOG_ROWS} WHERE sequence >= (SELECT (max(event_id) + 1) // 2 FROM events)",
    ),
    "tick_log_stream": _query(_MESSAGE, _LOG_ROWS),
    "sliding_window_assign": _query(
        f"""{_NULL_TIME},{_windowed("text_tick", "1 minute", 5, 'WHERE "timestamp" IS NOT NULL')}""",
        """SELECT sequence, pair, "timestamp", open_time,
       open_time + INTERVAL '5 minutes' AS close_time FROM placed""",
    ),
    "candles_5m_1m": _query(_candles(_EXACT_MIDS), _ALL_CANDLES),
    "candles_5m_1m_clean": _query(_CLEAN_CANDLES, _ALL_CANDLES),
    "candles_5m_1m_direct": _query(_CLEAN_CANDLES, _ALL_CANDLES),
    "candles_5m_1m_compat": _query(_candles(_COMPAT_MIDS), _ALL_CANDLES),
    "candles_5m_1m_null_mids": _query(_candles(_NULL_MIDS, nulls=True), _ALL_CANDLES),
    "candles_1d_6h": _DAY_FROM_LOG,
    "candles_1d_1m": _query(_candles(_EXACT_MIDS, _DAY_EACH_MINUTE), _ALL_CANDLES),
    # The farthest of the 13 starts back from a tick lies up to 91 minutes before it.
    "candles_90m_7m": _query(
        _candles(
            _CLEAN_MIDS,
            _NINETY_BY_SEVEN,
            reached="\"timestamp\" < open_time + INTERVAL '90 minutes'",
        ),
        _ALL_CANDLES,
    ),
    "candles_from_panes": _query(_CLEAN_CANDLES, _ALL_CANDLES),
    "candles_1d_6h_from_panes": _query(_candles(_CLEAN_MIDS, _DAY), _ALL_CANDLES),
    "candle_low_high": _query(
        _CLEAN_CANDLES, "SELECT currency_pair, open_time, low_price, high_price FROM candle"
    ),
    "candle_open_close": _query(
        _candles(_CLEAN_MIDS, _DAY),
        "SELECT currency_pair, open_time, open_price, close_price FROM candle",
    ),
    "candle_not_null_violations": _query(
        _candles(_NULL_MIDS, nulls=True),
        """SELECT count(*) AS violations FROM candle
WHERE currency_pair IS NULL OR open_price IS NULL OR high_price IS NULL OR low_price IS NULL
   OR close_price IS NULL OR open_time IS NULL OR close_time IS NULL""",
    ),
    "candle_unique_violations": _query(
        _candles(_CLEAN_MIDS, _DAY, epoch="sequence % 4"),
        """SELECT count(*) AS violations FROM (
  SELECT 1 FROM candle GROUP BY currency_pair, open_time HAVING count(*) > 1)""",
    ),
    "candles_ordered_limit": _query(
        _CLEAN_CANDLES, f"{_ALL_CANDLES} ORDER BY currency_pair, open_time LIMIT 30"
    ),
    "latest_12_candles": _latest(_CLEAN_CANDLES),
    "latest_12_disjoint_candles": _latest(_CLEAN_CANDLES, disjoint=True),
    "upsert_merged_by_size": _query(_CLEAN_CANDLES, _ALL_CANDLES),
    "latest_12_from_table": _latest(_LIVE_CANDLES),
    "latest_12_disjoint_from_table": _latest(_LIVE_CANDLES, disjoint=True),
    "upsert_latest_wins": _UPSERTED,
    "upsert_compacted": _UPSERTED,
    "upsert_compact_ahead": _UPSERTED,
    "compact_resumed": _UPSERTED,
    "candles_any_sequence": _query(
        _candles(
            f"""{_CLEAN_MIDS.replace("mids AS", "plain AS")},
mids AS (
  SELECT pair, date_trunc('minute', "timestamp") AS "timestamp", mid_price,
         CASE sequence % 3 WHEN 0 THEN -sequence
              WHEN 1 THEN sequence * 10000000000000 ELSE sequence END AS sequence
  FROM plain)""",
            _DAY,
        ),
        _ALL_CANDLES,
    ),
    "message_sequence_order": _query(
        _candles(
            f"""{_EXACT_MIDS.replace("mids AS", "plain AS")},
mids AS (
  SELECT pair, date_trunc('minute', "timestamp") AS "timestamp", mid_price, sequence FROM plain)""",
            _DAY,
        ),
        _ALL_CANDLES,
    ),
    "tick_quality_precision": """
SELECT event_id AS sequence, printf('%d.%09d', event_id, event_id % 100) AS bid,
       CASE WHEN event_id % 10 <> 0 THEN 'unrepresentable' END AS reason FROM events""",
    "tick_quality_no_pair": _query(
        _candles(
            f"""{_CLEAN_MIDS.replace("mids AS", "plain AS")},
mids AS (SELECT * FROM plain WHERE sequence % 7 <> 0)""",
            _DAY,
        ),
        _ALL_CANDLES,
    ),
    "log_read_ungated": _query(_MESSAGE, _LOG_ROWS),
    "log_stream_before_ingest": _query(_MESSAGE, _LOG_ROWS),
    "replay_from_time": _query(_MESSAGE, f'{_LOG_ROWS} WHERE "timestamp" >= {_FAILURE}'),
    "candles_replayed_from_time": _query(
        _candles(_EXACT_MIDS), f"{_ALL_CANDLES} WHERE close_time > {_FAILURE}"
    ),
    "stream_reject_counts": _query(_graded(_EXACT_PRICE), _SUMMARY),
    "backfill_then_stream": _DAY_FROM_LOG,
    "stream_source_count": _query(
        _MESSAGE, "SELECT key, CAST(count(*) AS BIGINT) AS messages FROM message GROUP BY key"
    ),
    "candle_stream_upsert": _query(_candles(_EXACT_MIDS), _ALL_CANDLES),
    "candle_stream_late": _DAY_FROM_LOG,
    "candle_stream_watermark_late": _DAY_FROM_LOG,
    "candle_pane_stream": _query(_candles(_EXACT_MIDS), _ALL_CANDLES),
    "restart_no_regression": _DAY_FROM_LOG,
}
