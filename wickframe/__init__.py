"""Candlesticks from best-bid/best-ask quotes, as Spark DataFrame transforms.

Quotes are parsed and graded (``operators.ingest``, ``operators.decode``), turned into mid prices
and open/high/low/close candles over sliding windows (``operators.ohlc``), kept current in a
Parquet candle table (``streaming.table``) and read back (``operators.reads``).  The same
transforms serve batch backfills (``plans``) and Structured Streaming (``streaming``).
"""
