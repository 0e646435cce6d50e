"""Upsert sinks for an external row store reached through a Python DB-API driver.

The Parquet candle table is the default sink. These are for readers that poll a relational table.

:class:`BatchStore` takes whole micro-batches: tasks write their Arrow batches into a staging table, and the
driver moves what succeeded with one upsert, in the transaction that records the epoch.
:class:`RowStoreWriter` is the plain writer for ``DataFrameWriter.foreach``, for small change rates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import closing
from dataclasses import dataclass
from itertools import repeat
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from wickframe.schemas import CANDLE_COLUMNS, CANDLE_KEY, CANDLE_PRICES


def _column_types() -> dict[str, str]:
    types = dict.fromkeys(CANDLE_PRICES, "numeric")
    types |= {"currency_pair": "text", "open_time": "timestamp", "close_time": "timestamp"}
    return {c: types[c] for c in CANDLE_COLUMNS}


def table_ddl(table: str) -> str:
    """The table's contract: no NULLs, one row per pair and open time."""
    columns = ", ".join(f"{name} {kind} not null" for name, kind in _column_types().items())
    return f"create table {table} ({columns}, unique ({', '.join(CANDLE_KEY)}))"


def _on_conflict() -> str:
    return f"on conflict ({', '.join(CANDLE_KEY)}) do update set {', '.join(f'{c} = excluded.{c}' for c in CANDLE_PRICES)}"


def batch_store_ddl(table: str) -> list[str]:
    """Statements for the table and what :class:`BatchStore` needs beside it.

    Staged rows belong to one attempt of one task; candles that break the contract are kept in ``_refused``.
    """
    loose = ", ".join(f"{name} {kind}" for name, kind in _column_types().items())
    return [
        table_ddl(table),
        f"create table {table}_staging (stream text not null, run text not null, attempt bigint not null, {loose})",
        f"create index {table}_staging_run on {table}_staging (run, attempt)",
        f"create table {table}_refused (stream text not null, epoch bigint not null, {loose})",
        f"create table {table}_epochs (stream text primary key, epoch bigint not null)",
    ]


def upsert_statement(table: str, marker: str = "%s") -> str:
    """Insert a candle, or replace the prices of the one with the same key."""
    return (
        f"insert into {table} ({', '.join(CANDLE_COLUMNS)})"
        f" values ({', '.join([marker] * len(CANDLE_COLUMNS))}) {_on_conflict()}"
    )


@dataclass(frozen=True)
class BatchStore:
    """A relational table that takes a stream's micro-batches whole, each once.

    ``connect`` is called in tasks and on the driver, so credentials can come from the environment there.
    ``stream`` names the stream whose epochs are recorded; its checkpoint's folder will do. ``as_text`` hands
    over prices and times as text, for drivers without decimals. Drivers that take columns or files faster than
    ``executemany`` does can be given as ``stage(cursor, statement, rows)``.
    """

    connect: Callable[[], Any]
    table: str
    stream: str
    marker: str = "%s"
    as_text: bool = False
    stage: Callable[[Any, str, Iterator[tuple]], Any] | None = None

    def __call__(self, batch: DataFrame, epoch: int) -> bool:
        """Write one micro-batch; False if the store has had the epoch before, and nothing was changed.

        The batch is computed in any case, since the stream's state depends on it. Rows of tasks that failed,
        or ran twice, stay in staging and are never moved; the next epoch removes them.
        """
        run = uuid.uuid4().hex
        staged = batch.select(*CANDLE_COLUMNS).mapInArrow(_staging(self, run), "attempt bigint, candles bigint")
        attempts = [row["attempt"] for row in staged.collect()]  # one row for each task
        with closing(self.connect()) as db:
            cursor = db.cursor()
            recorded = self._recorded(cursor)
            is_new = recorded is None or epoch > recorded
            if is_new:
                self._move(cursor, run, attempts, epoch, recorded)
            cursor.execute(f"delete from {self.table}_staging where stream = {self.marker}", (self.stream,))
            db.commit()
            cursor.close()
        return is_new

    def _recorded(self, cursor: Any) -> int | None:
        cursor.execute(f"select epoch from {self.table}_epochs where stream = {self.marker}", (self.stream,))
        row = cursor.fetchone()
        return None if row is None else int(row[0])

    def _move(self, cursor: Any, run: str, attempts: list[int], epoch: int, recorded: int | None) -> None:
        """Upsert staged rows and record the epoch; the caller commits both at once, or neither."""
        columns, mark = ", ".join(CANDLE_COLUMNS), self.marker
        whole = " and ".join(f"{c} is not null" for c in CANDLE_COLUMNS)
        if recorded is None:
            cursor.execute(f"insert into {self.table}_epochs (stream, epoch) values ({mark}, {mark})", (self.stream, epoch))
        else:
            cursor.execute(f"update {self.table}_epochs set epoch = {mark} where stream = {mark}", (epoch, self.stream))
        for start in range(0, len(attempts), 500):  # parameters of one statement are limited
            some = attempts[start : start + 500]
            mine = f"from {self.table}_staging where run = {mark} and attempt in ({', '.join([mark] * len(some))})"
            cursor.execute(
                f"insert into {self.table} ({columns}) select {columns} {mine} and {whole} {_on_conflict()}", (run, *some)
            )
            cursor.execute(
                f"insert into {self.table}_refused (stream, epoch, {columns}) select {mark}, {mark}, {columns} {mine} and not ({whole})",
                (self.stream, epoch, run, *some),
            )


def _staging(store: BatchStore, run: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's part: all its Arrow batches into staging, in one transaction. Columns become rows outside Python."""
    marks = ", ".join([store.marker] * (3 + len(CANDLE_COLUMNS)))
    statement = f"insert into {store.table}_staging (stream, run, attempt, {', '.join(CANDLE_COLUMNS)}) values ({marks})"

    def values(column: pa.Array) -> list:
        return (column.cast(pa.string()) if store.as_text else column).to_pylist()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, candles, db = TaskContext.get().taskAttemptId(), 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                db = db or store.connect()
                cursor = db.cursor()
                rows = zip(repeat(store.stream), repeat(run), repeat(attempt), *(values(batch.column(c)) for c in CANDLE_COLUMNS))
                if store.stage:
                    store.stage(cursor, statement, rows)
                else:
                    cursor.executemany(statement, rows)
                cursor.close()
                candles += batch.num_rows
            if db:
                db.commit()
        finally:
            if db:
                db.close()
        if candles:
            yield pa.RecordBatch.from_arrays([pa.array([attempt]), pa.array([candles])], ["attempt", "candles"])

    return write


class RowStoreWriter:
    """Writes candles of one task in transactions of ``rows_per_commit`` rows.

    ``connect`` is called on the executor, so credentials can come from its environment. Upserts
    are keyed, so a task that is run again leaves the same rows.
    """

    def __init__(
        self,
        connect: Callable[[], Any],
        table: str,
        marker: str = "%s",
        rows_per_commit: int = 1000,
        convert: Callable[[Any], Any] = lambda value: value,
    ) -> None:
        self._connect = connect
        self._statement = upsert_statement(table, marker)
        self._rows_per_commit = rows_per_commit
        self._convert = convert
        self._connection: Any = None
        self._pending: list[Sequence[Any]] = []

    def open(self, partition_id: int, epoch_id: int) -> bool:
        # Connects on the first row: most tasks of a small micro-batch have none.
        self._pending = []
        return True

    def process(self, row: Any) -> None:
        self._pending.append(tuple(self._convert(row[c]) for c in CANDLE_COLUMNS))
        if len(self._pending) >= self._rows_per_commit:
            self._flush()

    def close(self, error: Exception | None) -> None:
        try:
            if error is None:
                self._flush()
        finally:
            if self._connection is not None:
                self._connection.close()
                self._connection = None

    def _flush(self) -> None:
        if not self._pending:
            return
        if self._connection is None:
            self._connection = self._connect()
        cursor = self._connection.cursor()
        cursor.executemany(self._statement, self._pending)
        self._connection.commit()
        cursor.close()
        self._pending = []
