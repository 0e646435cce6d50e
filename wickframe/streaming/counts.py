"""Counts of rejects while a stream runs, without reading anything twice."""

from __future__ import annotations

import threading
import time
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wickframe.operators.ingest import reason_counts

# The name under which a stream's progress has the counts of its batch.
OBSERVED = "tick_quality"


def observed(graded: DataFrame) -> DataFrame:
    """Graded ticks, counted by reason as they pass; the counts come with the progress of each batch."""
    return graded.observe(OBSERVED, *reason_counts())


class RejectCounts(StreamingQueryListener):
    """Keeps what :func:`observed` counted, by query and batch. Add it to ``spark.streams``.

    A batch that is run again replaces its counts. With ``path`` they are kept as files too, a folder for each
    batch, so that they outlive the driver and others can read them while the stream runs.
    """

    def __init__(self, path: str | None = None) -> None:
        self._path = path
        self._batches: dict[tuple[str, int], dict[str, int]] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None:
            return
        found = {reason: ticks for reason, ticks in counts.asDict().items() if ticks}
        if self._path and found:
            folder = f"{self._path}/query_id={progress.id}/batch_id={progress.batchId}"
            rows = SparkSession.active().createDataFrame(sorted(found.items()), "reason string, ticks bigint")
            rows.coalesce(1).write.mode("overwrite").parquet(folder)
        with self._changed:
            self._batches[str(progress.id), progress.batchId] = found
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the counts of the query's last batch are here; events come a little after the batch."""
        last = query.lastProgress
        if last is None or OBSERVED not in last["observedMetrics"]:
            return
        until = time.monotonic() + seconds
        with self._changed:
            while (str(query.id), last["batchId"]) not in self._batches:
                if not self._changed.wait(until - time.monotonic()):
                    raise TimeoutError("no progress event")

    def of_batches(self, query: StreamingQuery | None = None) -> dict[int, dict[str, int]]:
        """Counts by batch, of one query or of all together."""
        with self._changed:
            mine = [(batch, found) for (name, batch), found in self._batches.items() if query is None or name == str(query.id)]
        out: dict[int, Counter] = {}
        for batch, found in mine:
            out.setdefault(batch, Counter()).update(found)
        return {batch: dict(found) for batch, found in sorted(out.items())}

    def total(self, query: StreamingQuery | None = None) -> dict[str, int]:
        out: Counter = Counter()
        for found in self.of_batches(query).values():
            out.update(found)
        return dict(out)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(reason, ticks, query_id, batch_id)`` of all batches kept under ``path``."""
    rows = spark.read.schema("reason string, ticks bigint, query_id string, batch_id bigint")
    return rows.option("basePath", path).parquet(path)
