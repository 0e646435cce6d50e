"""The candle table: Parquet, last write per ``(currency_pair, open_time)`` wins.

Every micro-batch writes its changed candles into a folder of its own, partitioned by the date of
``open_time``::

    <table>/version=14/valid=true/open_date=2024-01-01/part-….parquet

A replayed batch overwrites its own folder and nothing else, so at-least-once delivery leaves the
same table. Readers take the newest version of each key. Epoch ``n`` writes version ``2n``;
merging the latest epochs up to ``n``, or all, writes version ``2n + 1``, which holds the rows that win
among those. A reader therefore gets the same rows before, during and after a merge. What was merged
is left out by readers once the merge is complete, and removed some time later, so that a reader
that planned before still finds its files (:mod:`wickframe.streaming.upkeep`).

A backfill takes the slot of the epoch after the last one, and a stream that starts or resumes numbers
its epochs after all there are, so neither replaces what the other wrote. One writer works at a time.

The table marks merges that are complete under ``_merged``, and what it holds under ``_layout``: candles
or panes, and the type of their prices. Marks are its own; committers need not leave any.

Candles that break the NOT NULL contract are kept under ``valid=false``, out of readers' sight.

A pane table has the same folders. Its rows are parts of panes that readers merge, so epochs add up
instead of replacing each other, and need no state between them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.operators.contract import breaks_not_null
from wickframe.operators.ohlc import SIZE, SLIDE, merge_late, merge_panes, roll_up
from wickframe.operators.reads import latest
from wickframe.schemas import (
    CANDLE_COLUMNS,
    CANDLE_KEY,
    COMPAT,
    EXACT,
    PriceMode,
    candle_schema,
    pane_schema,
    ranked_schema,
)
from wickframe.session import scoped_conf
from wickframe.streaming import paths
from wickframe.streaming.upkeep import (
    WHOLE,
    Merge,
    complete,
    due,
    levels,
    live,
    merges,
    remove_merged,
    stored_versions,
)

# Versions of a size before they are merged, and seconds that readers have after a merge.
FANOUT = 16
KEEP_FOR = 600.0

# A pair whose newest candle is older than this many days, against the table's newest, is not live.
LIVE_DAYS = 7


@dataclass(frozen=True)
class Layout:
    """What one kind of table holds, and how versions of a key become one row."""

    kind: str
    rows: T.StructType
    time: str
    merge: Callable[[DataFrame], DataFrame]

    @property
    def stored(self) -> T.StructType:
        return T.StructType(
            [
                *self.rows,
                T.StructField("version", T.LongType()),
                T.StructField("valid", T.BooleanType()),
                T.StructField("open_date", T.DateType()),
            ]
        )


def _newest(stored: DataFrame, columns: Sequence[str] = CANDLE_COLUMNS) -> DataFrame:
    """Newest version of each key, as a hash aggregation that starts on the map side."""
    values = [c for c in columns if c not in CANDLE_KEY]
    return (
        stored.groupBy(*CANDLE_KEY)
        .agg(*(F.max_by(c, "version").alias(c) for c in values))
        .select(*columns)
    )


def candle_layout(mode: PriceMode = EXACT) -> Layout:
    return Layout("candles", candle_schema(mode), "open_time", _newest)


def ranked_layout(mode: PriceMode = EXACT) -> Layout:
    """Candles that late ticks can be merged into."""
    rows = ranked_schema(mode)
    return Layout("ranked", rows, "open_time", lambda stored: _newest(stored, rows.names))


def pane_layout(mode: PriceMode = EXACT) -> Layout:
    return Layout("panes", pane_schema(mode), "pane_start", merge_panes)


def _label(kind: str, price: T.DataType) -> str:
    if isinstance(price, T.DecimalType):
        return f"{kind}-decimal-{price.precision}-{price.scale}"
    return f"{kind}-{price.simpleString()}"


def _record(spark: SparkSession, path: str, label: str) -> None:
    """Note what the table holds; refuse rows of another kind or price type."""
    known = paths.children(spark, f"{path}/_layout")
    if not known:
        paths.mark(spark, f"{path}/_layout/{label}")
    elif label not in known:
        raise ValueError(f"{path} holds {known[0]}, not {label}")


def stored_mode(spark: SparkSession, path: str, kind: str, mode: PriceMode | None) -> PriceMode:
    """The mode of a table's prices; ``mode`` where given, which must fit."""
    known = paths.children(spark, f"{path}/_layout")
    if not known:
        return mode or EXACT
    held, _, price = known[0].partition("-")
    if held != kind or mode and known[0] != _label(kind, mode.mid_type):
        raise ValueError(f"{path} holds {known[0]}")
    if price.startswith("decimal-"):
        precision, scale = map(int, price.split("-")[1:])
        return PriceMode("stored", precision, scale, mid_is_double=False)
    return COMPAT


def next_epoch(spark: SparkSession, path: str) -> int:
    """The first epoch after all the table has."""
    return max((version // 2 + 1 for version in stored_versions(spark, path)), default=0)


def _write(
    rows: DataFrame, layout: Layout, path: str, version: int, merge_files: bool = True
) -> None:
    columns = layout.rows.names
    _record(rows.sparkSession, path, _label(layout.kind, rows.schema["open_price"].dataType))
    rows = rows.select(
        *columns,
        (~breaks_not_null(columns)).alias("valid"),
        F.to_date(layout.time).alias("open_date"),
    )
    adaptive = {}
    if merge_files:
        # Rebalancing merges the shuffle partitions of a small batch into one file per date and
        # splits a date that is too large for one. It needs adaptive execution, which streams
        # switch off.
        rows = rows.hint("rebalance", F.col("valid"), F.col("open_date"))
        adaptive = {"spark.sql.adaptive.enabled": "true"}
    with scoped_conf(rows.sparkSession, adaptive):
        (
            rows.write.mode("overwrite")
            .partitionBy("valid", "open_date")
            .parquet(f"{path}/version={version}")
        )


def _stored(
    spark: SparkSession,
    layout: Layout,
    path: str,
    since: date | None = None,
    until: date | None = None,
    refused: bool = False,
    versions: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of the versions that count, or of those given."""
    if versions is None:
        done = merges(spark, path)
        versions = live(stored_versions(spark, path), done, refused)
    folders = [f"{path}/version={version}" for version in versions] or [path]
    rows = spark.read.schema(layout.stored).option("basePath", path).parquet(*folders)
    if since is not None:
        rows = rows.filter(F.col("open_date") >= F.lit(since))
    if until is not None:
        rows = rows.filter(F.col("open_date") <= F.lit(until))
    return rows


def write_epoch(
    candle_rows: DataFrame, path: str, epoch_id: int, merge_files: bool = True
) -> None:
    """Upsert one batch of candles as epoch ``epoch_id``, in one pass over the batch.

    Without ``merge_files`` every partition writes its own files: quicker for few partitions.
    """
    _write(candle_rows, candle_layout(), path, 2 * epoch_id, merge_files)


def write_backfill(candle_rows: DataFrame, path: str) -> int:
    """Upsert candles of a batch job as the epoch after all there are, which is returned."""
    epoch = next_epoch(candle_rows.sparkSession, path)
    write_epoch(candle_rows, path, epoch)
    return epoch


def stored_candles(spark: SparkSession, path: str, mode: PriceMode | None = None) -> DataFrame:
    """All versions of all candles that meet the contract, with ``version``."""
    mode = stored_mode(spark, path, "candles", mode)
    return _stored(spark, candle_layout(mode), path).filter("valid").select(*CANDLE_COLUMNS, "version")


def current_candles(
    spark: SparkSession,
    path: str,
    mode: PriceMode | None = None,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """The table as readers see it. ``since``/``until`` bound ``open_date`` and prune folders."""
    mode = stored_mode(spark, path, "candles", mode)
    return _newest(_stored(spark, candle_layout(mode), path, since, until).filter("valid"))


def _dates(spark: SparkSession, path: str) -> dict[date, list[str]]:
    """The folders of each open date, of versions that count; one listing for each version."""
    found: dict[date, list[str]] = {}
    for version in live(stored_versions(spark, path), merges(spark, path)):
        top = f"{path}/version={version}/valid=true"
        for name in paths.children(spark, top):
            found.setdefault(date.fromisoformat(name.removeprefix("open_date=")), []).append(f"{top}/{name}")
    return found


def latest_candles(
    spark: SparkSession,
    path: str,
    n: int = 12,
    pick: Callable[[DataFrame, int], DataFrame] = latest,
    live_days: int = LIVE_DAYS,
    mode: PriceMode | None = None,
) -> DataFrame:
    """The ``n`` newest candles of each live pair, from as few dates as hold them.

    A pair is live if it has a candle in the ``live_days`` days up to the newest date of the table. Those
    days are read first; while a live pair has fewer than ``n`` candles, twice as many dates are, back to
    the first one. So what is read follows how densely candles lie, not how long the table is kept. Only folders that
    are read are listed below their version. ``pick`` takes the rows of each pair: ``reads.latest`` or another
    that needs no older row once it has ``n``.
    """
    layout = candle_layout(stored_mode(spark, path, "candles", mode))
    folders = _dates(spark, path)
    days = sorted(folders, reverse=True)
    if not days:
        return pick(spark.createDataFrame([], layout.rows), n)
    count = sum(day > days[0] - timedelta(days=live_days) for day in days)
    pairs = None
    while True:
        taken = [folder for day in days[:count] for folder in folders[day]]
        stored = spark.read.schema(layout.stored).option("basePath", path).parquet(*taken)
        rows = pick(_newest(stored), n)
        if pairs is None:
            pairs = rows.select("currency_pair").distinct()
        else:
            rows = rows.join(pairs, "currency_pair", "left_semi")
        if count >= len(days) or rows.groupBy("currency_pair").count().filter(F.col("count") < n).isEmpty():
            return rows
        count = min(len(days), 2 * count)


def quarantined_candles(
    spark: SparkSession, path: str, mode: PriceMode | None = None
) -> DataFrame:
    """Candles the contract refused, with the version that wrote them."""
    mode = stored_mode(spark, path, "candles", mode)
    refused = _stored(spark, candle_layout(mode), path, refused=True).filter("not valid")
    return refused.select(*CANDLE_COLUMNS, "version")


def write_pane_epoch(pane_parts: DataFrame, path: str, epoch_id: int) -> None:
    """Add the pane parts of one batch as epoch ``epoch_id``."""
    _write(pane_parts, pane_layout(), path, 2 * epoch_id)


def write_ranked_epoch(
    candle_rows: DataFrame, path: str, epoch_id: int, merge_files: bool = True
) -> None:
    """:func:`write_epoch` for candles with ranks."""
    _write(candle_rows, ranked_layout(), path, 2 * epoch_id, merge_files)


def candles_with_late(
    spark: SparkSession,
    path: str,
    late_path: str,
    size: str = SIZE,
    slide: str = SLIDE,
    mode: PriceMode | None = None,
) -> DataFrame:
    """Candles of a stream with a watermark, merged with the ticks that came behind it (``start_late_stream``)."""
    layout = ranked_layout(stored_mode(spark, path, "ranked", mode))
    rows = layout.merge(_stored(spark, layout, path).filter("valid"))
    return merge_late(rows, current_panes(spark, late_path, mode), size, slide)


def current_panes(
    spark: SparkSession, path: str, mode: PriceMode | None = None, since: date | None = None
) -> DataFrame:
    """Whole panes, merged from all their parts."""
    mode = stored_mode(spark, path, "panes", mode)
    return merge_panes(_stored(spark, pane_layout(mode), path, since).filter("valid"))


def candles_of_panes(
    spark: SparkSession,
    path: str,
    size: str = SIZE,
    slide: str = SLIDE,
    mode: PriceMode | None = None,
    since: date | None = None,
) -> DataFrame:
    """Candles of a pane table, for any window its panes tile; ``since`` bounds ``open_time``."""
    rows = roll_up(current_panes(spark, path, mode, since), size, slide)
    # Windows that open before the first pane read would lack their earlier panes.
    return rows if since is None else rows.filter(F.to_date("open_time") >= F.lit(since))


def _millis() -> int:
    return int(time.time() * 1000)


def compact(
    spark: SparkSession,
    path: str,
    upto_epoch: int | None = None,
    layout: Layout | None = None,
    keep_for: float = 0,
) -> list[date]:
    """Merge the epochs up to one, date by date, and remove them; all there are unless given.

    An epoch the table does not have yet stands for the last one it has: what a stream writes later
    is newer than the merge. Only dates those epochs touched are rewritten; they are returned. A
    compaction that was lost halfway is finished by calling it again. Readers that planned before the
    removal lose their files; with ``keep_for`` seconds a later call or merge removes them instead.

    Where the newest version is a merge by size of its own, it stays, with all that is older.
    """
    done = merges(spark, path)
    level = levels(done)
    stored = stored_versions(spark, path)
    counted = live(stored, done)
    last = max(stored, default=0) if upto_epoch is None else 2 * upto_epoch + 1
    young = [v for v in counted if level.get(v, 0) < WHOLE and v <= last]
    days = []
    merged = 2 * (max(young) // 2) + 1 if young else 0
    if young and merged not in level:
        if layout is None:
            layout = candle_layout(stored_mode(spark, path, "candles", None))
        # Dates that only versions touched whose removal was lost are written again with the others.
        left = [v for v in stored if not keep_for and v not in counted and level.get(v, 0) < WHOLE]
        touching = [v for v in (*young, *left) if v < merged]
        touched = _stored(spark, layout, path, versions=touching).filter("valid")
        days = sorted(r.open_date for r in touched.select("open_date").distinct().collect())
        rows = _stored(spark, layout, path, versions=[v for v in counted if v < merged]).filter("valid")
        _write(layout.merge(rows.filter(F.col("open_date").isin(days))), layout, path, merged)
        complete(spark, path, Merge(merged, at=_millis()))
    remove_merged(spark, path, _millis(), keep_for)
    return days


def merge_by_size(
    spark: SparkSession,
    path: str,
    layout: Layout | None = None,
    fanout: int = FANOUT,
    keep_for: float = KEEP_FOR,
) -> int | None:
    """What a stream does after an epoch: merge if enough versions of a size are there, remove what is long merged.

    Returns the merged version, if any. At most ``fanout`` versions of each size are left to readers, and
    sizes are powers of ``fanout``. Lost halfway, it is made good by the next call.
    """
    done = merges(spark, path)
    counted = live(stored_versions(spark, path), done)
    found = due(counted, levels(done), fanout)
    merged = None
    if found:
        sources, level = found
        merged = 2 * (max(sources) // 2) + 1
        if layout is None:
            layout = candle_layout(stored_mode(spark, path, "candles", None))
        # A lost merge of the same number is written anew from what it was made of.
        rows = _stored(spark, layout, path, versions=[v for v in sources if v < merged])
        refused = rows.filter("not valid").select(*layout.rows.names)
        valid = layout.merge(rows.filter("valid")).select(*layout.rows.names)
        _write(valid.unionByName(refused), layout, path, merged)
        complete(spark, path, Merge(merged, min(sources), level, _millis()))
    if found or done:
        remove_merged(spark, path, _millis(), keep_for)
    return merged
