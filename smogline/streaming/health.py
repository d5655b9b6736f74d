"""How a stream is doing: counts for each micro-batch, its lag, and a stop between two batches."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from smogline.operators.forecast import REASON

METRICS = "readings"


@dataclass(frozen=True)
class Progress:
    """One micro-batch: rows, rejected ones, the newest reading's time, and how far behind the clock that was."""

    batch_id: int
    rows: int
    rejected: int
    newest: int | None
    lag_seconds: float | None

    @property
    def rejected_share(self) -> float:
        return self.rejected / self.rows if self.rows else 0.0


def observed(readings: DataFrame) -> DataFrame:
    """The parsed readings with counters, taken while they pass; nothing is computed twice."""
    return readings.observe(
        METRICS,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
        F.max("timestamp").alias("newest"),
    )


class Health(StreamingQueryListener):
    """Keeps the progress of the streams of a session; ``tell`` is called with each, from Spark's listener thread."""

    def __init__(self, tell: Callable[[Progress], None] | None = None, keep: int = 1000):
        self.tell, self.keep = tell, keep
        self.seen: list[Progress] = []
        self.failure: str | None = None
        self.ended = threading.Event()
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        metrics = event.progress.observedMetrics.get(METRICS)
        if metrics is None:
            return
        at = datetime.fromisoformat(event.progress.timestamp.replace("Z", "+00:00")).timestamp()
        lag = at - metrics.newest if metrics.newest is not None else None
        found = Progress(event.progress.batchId, metrics.rows, metrics.rejected, metrics.newest, lag)
        with self.lock:
            self.seen = [*self.seen, found][-self.keep :]
        if self.tell is not None:
            self.tell(found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failure = event.exception
        self.ended.set()

    def totals(self) -> tuple[int, int]:
        """Rows and rejected rows of all batches seen; one that ran twice counts as it ran last."""
        with self.lock:
            last = {found.batch_id: found for found in self.seen}
        return sum(found.rows for found in last.values()), sum(found.rejected for found in last.values())


def stop_between_batches(query: StreamingQuery, seconds: float = 60.0, look_every: float = 0.02) -> bool:
    """Stop when no batch is running; False, and the stream goes on, if one runs through all that time."""
    until = time.monotonic() + seconds
    while query.isActive and query.status["isTriggerActive"]:
        if time.monotonic() >= until:
            return False
        time.sleep(look_every)
    query.stop()
    return True
