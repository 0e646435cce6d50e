"""How long it takes from a tick's time until a reader finds its candle."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Parts of a batch's candles whose newest ticks are kept: 1 %, 2 %, ... 100 %.
_PARTS = [part / 100 for part in range(1, 101)]


class Delays:
    """Delays of a candle stream, by batch.

    Candles carry the time of their newest tick through the state. When a batch can be read, the difference
    to the clock is the delay of each candle in it. The times are observed as the batch is written, so
    nothing is computed twice, and a hundred numbers for each batch come to the driver. Where ticks are stamped
    on arrival, this is the time from arrival to readable.
    """

    def __init__(self) -> None:
        self._batches: dict[int, tuple[int, list[float]]] = {}

    @contextmanager
    def measured(self, batch: DataFrame, epoch: int) -> Iterator[DataFrame]:
        """The batch to write inside of the block, without ``newest_tick``; the block ends when it can be read."""
        seen = Observation(f"delays-{epoch}")
        newest = F.unix_micros(F.col("newest_tick").cast("timestamp"))
        yield batch.observe(
            seen, F.count("newest_tick").alias("candles"), F.percentile_approx(newest, _PARTS, 10_000).alias("newest")
        ).drop("newest_tick")
        now = time.time() * 1_000_000
        found = seen.get
        if found["candles"]:
            self._batches[epoch] = (found["candles"], [(now - at) / 1_000_000 for at in found["newest"]])

    def percentile(self, part: float, skip: int = 0) -> float | None:
        """Seconds within which ``part`` of all candles could be read; the first ``skip`` batches do not count."""
        batches = [self._batches[epoch] for epoch in sorted(self._batches)[skip:]]
        weighed = sorted((delay, candles) for candles, some in batches for delay in some)
        whole = sum(candles for _, candles in weighed)
        reached = 0
        for delay, candles in weighed:
            reached += candles
            if reached >= part * whole:
                return delay
        return None

    @property
    def batches(self) -> int:
        return len(self._batches)
