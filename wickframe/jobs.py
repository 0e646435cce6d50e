"""Jobs for spark-submit.

    spark-submit wickframe_job.py ingest   --raw quotes/ --log log/ --checkpoint chk/ingest
    spark-submit wickframe_job.py stream   --log log/ --table candles/ --checkpoint chk/candles
    spark-submit wickframe_job.py backfill --log log/ --table candles/
    spark-submit wickframe_job.py latest   --table candles/ --since 2024-01-30
    spark-submit wickframe_job.py compact  --table candles/ --upto-epoch 1200

``--servers`` and ``--topic`` replace ``--log`` by a Kafka topic. Under ``--sequence-limit``, messages outside
the limit are kept in ``--rejects``.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wickframe.operators import decode, reads
from wickframe.operators.ohlc import SIZE, SLIDE
from wickframe.plans.candles import candles_from_log, candles_since, quotes_from_raw
from wickframe.schemas import COMPAT, EXACT
from wickframe.session import build_session, pin_utc
from wickframe.sources.quotes import read_raw
from wickframe.sources.ticklog import FileLog, KafkaLog, LogSource, between, read_log
from wickframe.streaming import stream, table
from wickframe.streaming.counts import RejectCounts

MODES = {mode.name: mode for mode in (EXACT, COMPAT)}


def _log_source(args: argparse.Namespace) -> LogSource:
    if args.servers:
        return KafkaLog(
            tuple(args.servers.split(",")),
            args.topic,
            starting_offsets=args.starting_offsets,
            min_partitions=args.min_partitions,
        )
    return FileLog(args.log, format=args.format)


def _trigger(args: argparse.Namespace) -> dict[str, Any] | None:
    if args.once:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def _rejects(args: argparse.Namespace, job: str) -> str:
    top = args.rejects or f"{args.table.rstrip('/')}_rejects"
    return f"{top}/job={job}"


def _await_all(queries: list[StreamingQuery]) -> None:
    """Wait until all have ended; the failure of one ends the others."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    pairs = args.pairs.split(",") if args.pairs else None
    raw = read_raw(spark, args.raw, streaming=True, format=args.format, arrival=args.arrival)
    quotes = quotes_from_raw(raw, args.arrival, pairs)
    if args.servers:
        query = stream.start_kafka_producer(
            quotes, tuple(args.servers.split(",")), args.topic, args.checkpoint,
            trigger=_trigger(args),
        )
    else:
        counts = RejectCounts(args.counts)
        spark.streams.addListener(counts)
        query = stream.start_ingest_stream(
            quotes, args.log, args.checkpoint, trigger=_trigger(args)
        )
        query.awaitTermination()
        counts.wait_for(query)
        spark.streams.removeListener(counts)
        print(" ".join(f"{reason}={ticks}" for reason, ticks in sorted(counts.total().items())))
        return
    query.awaitTermination()


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    log = read_log(spark, _log_source(args), streaming=True)
    mids = decode.mids_from_messages(log, MODES[args.mode])
    queries = []
    if args.sequence_limit is not None:
        queries.append(
            stream.start_reject_stream(
                decode.outside_limit(log, args.sequence_limit, MODES[args.mode]),
                _rejects(args, "stream"),
                f"{args.checkpoint.rstrip('/')}_rejects",
                trigger=_trigger(args),
            )
        )
    if args.panes:
        candles = stream.start_pane_stream(
            mids,
            args.table,
            args.checkpoint,
            width=args.slide,
            sequence_limit=args.sequence_limit,
            trigger=_trigger(args),
            fanout=args.fanout,
            keep_for=args.keep_for,
        )
        _await_all([candles, *queries])
        return
    changes = stream.candle_stream(
        mids, args.size, args.slide, watermark=args.watermark, sequence_limit=args.sequence_limit
    )
    candles = stream.start_candle_stream(
        changes,
        args.table,
        args.checkpoint,
        trigger=_trigger(args),
        state_partitions=args.state_partitions,
        merge_files=not args.keep_files,
        fanout=args.fanout,
        keep_for=args.keep_for,
    )
    _await_all([candles, *queries])


def run_backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    log = read_log(spark, between(_log_source(args), args.from_time))
    if args.from_time is not None:
        candles = candles_since(
            spark, _log_source(args), args.from_time, args.size, args.slide, MODES[args.mode], args.sequence_limit
        )
    else:
        candles = candles_from_log(
            log, args.size, args.slide, MODES[args.mode], sequence_limit=args.sequence_limit
        )
    epoch = table.next_epoch(spark, args.table)
    if args.sequence_limit is not None:
        # A backfill that failed and runs again has the same epoch, and so the same folder.
        rejects = decode.outside_limit(log, args.sequence_limit, MODES[args.mode])
        rejects.write.mode("overwrite").parquet(f"{_rejects(args, 'backfill')}/epoch={epoch}")
    table.write_epoch(candles, args.table, epoch)


def latest_candles(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    mode = MODES[args.mode] if args.mode else None
    pick = reads.latest
    if args.disjoint:
        pick = partial(reads.latest_disjoint, size=args.size)
    if args.panes:
        current = table.candles_of_panes(
            spark, args.table, args.size, args.slide, mode, since=args.since
        )
    elif args.since is not None:
        current = table.current_candles(spark, args.table, mode, since=args.since)
    else:
        return table.latest_candles(spark, args.table, args.n, pick, args.live_days, mode)
    return pick(current, args.n)


def run_latest(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = latest_candles(spark, args).orderBy("currency_pair", "open_time")
    rows.show(args.show, truncate=False)


def run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    kind, layout = ("panes", table.pane_layout) if args.panes else ("candles", table.candle_layout)
    mode = table.stored_mode(spark, args.table, kind, MODES[args.mode] if args.mode else None)
    days = table.compact(spark, args.table, args.upto_epoch, layout(mode), args.keep_for)
    print(f"merged {len(days)} dates")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wickframe", description="Candlesticks from quotes.")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run: Any, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        sub.set_defaults(run=run)
        return sub

    def kafka(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--servers", help="Kafka bootstrap servers, separated by commas")
        sub.add_argument("--topic")

    def log_input(sub: argparse.ArgumentParser) -> None:
        kafka(sub)
        sub.add_argument("--starting-offsets", default="earliest")
        sub.add_argument("--min-partitions", type=int)
        sub.add_argument("--log", help="folder with log files")
        sub.add_argument("--format", default="parquet", choices=("parquet", "json"))
        sub.add_argument("--gated", action="store_true", help="not needed any more: rows tell")

    def streaming(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--once", action="store_true", help="stop at the end of the input")
        sub.add_argument("--every", help="trigger interval such as '500 milliseconds'")

    def candles(sub: argparse.ArgumentParser, mode: str | None = EXACT.name) -> None:
        sub.add_argument("--table", required=True)
        sub.add_argument("--mode", default=mode, choices=tuple(MODES))

    def pane_choice(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--panes", action="store_true", help="the table holds panes")

    def merging(sub: argparse.ArgumentParser) -> None:
        sub.add_argument(
            "--keep-for", type=float, default=table.KEEP_FOR, help="seconds until merged files are removed"
        )

    def windows(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--size", default=SIZE)
        sub.add_argument("--slide", default=SLIDE)
        sub.add_argument("--sequence-limit", type=int, help="sequences lie in [0, this): faster")
        sub.add_argument(
            "--rejects", help="folder for messages outside the limit; by default beside the table"
        )

    sub = job("ingest", run_ingest, "raw quotes to the message log")
    sub.add_argument("--raw", required=True, help="folder with raw quotes")
    sub.add_argument("--format", default="text", choices=("text", "parquet", "json"))
    sub.add_argument("--arrival", help="column that recorded when a quote came; not in text files")
    sub.add_argument("--pairs", help="only these pairs, separated by commas")
    sub.add_argument("--log", help="folder for log files")
    sub.add_argument("--counts", help="folder for the counts of rejects of each batch, kept while the job runs")
    kafka(sub)
    streaming(sub)

    sub = job("stream", run_stream, "keep the candle table current")
    log_input(sub)
    candles(sub)
    windows(sub)
    streaming(sub)
    pane_choice(sub)
    sub.add_argument("--watermark", help="drop ticks later than this; none by default")
    sub.add_argument("--state-partitions", type=int)
    merging(sub)
    sub.add_argument("--fanout", type=int, default=table.FANOUT, help="epochs merged at once; 0 for never")
    sub.add_argument(
        "--keep-files", action="store_true", help="a file per state partition and date, not merged"
    )

    sub = job("backfill", run_backfill, "candles of a stored log, in one batch")
    sub.add_argument(
        "--from-time", type=datetime.fromisoformat, help="only candles that ticks from then on can have changed"
    )
    log_input(sub)
    candles(sub)
    windows(sub)

    sub = job("latest", run_latest, "show the most recent candles of each pair")
    candles(sub, mode=None)
    sub.add_argument("--n", type=int, default=12)
    pane_choice(sub)
    sub.add_argument("--size", default=SIZE)
    sub.add_argument("--slide", default=SLIDE)
    sub.add_argument("--disjoint", action="store_true", help="candles that do not overlap")
    sub.add_argument("--since", type=date.fromisoformat, help="first open date to read")
    sub.add_argument(
        "--live-days", type=int, default=table.LIVE_DAYS, help="pairs without a candle for longer are left out"
    )
    sub.add_argument("--show", type=int, default=100, help="rows to print")

    sub = job("compact", run_compact, "merge table versions up to an epoch")
    candles(sub, mode=None)
    pane_choice(sub)
    merging(sub)
    sub.add_argument("--upto-epoch", type=int, help="all there are unless given")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(pin_utc(build_session(f"wickframe {args.job}")), args)


if __name__ == "__main__":
    main()
