"""Counters of a whole stream, which every task adds to and the driver reads."""

from __future__ import annotations

import json
import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sparkloom.files import read_bytes, replace_bytes


class StreamCounters(StreamingQueryListener):
    """Adds up what ``counted`` observes, each micro-batch once.

    Figures are kept per micro-batch: one that runs again, in this run or after a restart, replaces its own.
    ``path`` names a small file beside the checkpoint, so that a new driver goes on where the last one ended;
    counts of finished micro-batches are folded, and the last one stays by itself.
    """

    def __init__(self, name: str, path: str):
        self.name, self.path = name, path
        self._lock = threading.Condition()
        self._known = json.loads(read_bytes(path) or b'{"folded": {}, "upto": -1, "last": {}}')
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                self._take(event.progress.batchId, {k: int(v or 0) for k, v in row.asDict().items()})

    def _take(self, batch: int, figures: dict[str, int]) -> None:
        known = self._known
        if batch < known["upto"]:
            return                              # folded long ago
        if batch > known["upto"]:
            known["folded"], known["upto"] = self._sum(), batch
        known["last"] = figures
        replace_bytes(self.path, json.dumps(known).encode())

    def _sum(self) -> dict[str, int]:
        folded, last = self._known["folded"], self._known["last"]
        return {k: folded.get(k, 0) + last.get(k, 0) for k in {*folded, *last}}

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def totals(self, run_id: str, timeout: float = 60.0) -> dict[str, int]:
        """The counts after a run has ended; listeners hear of that a little later."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(run_id) in self._ended, timeout):
                raise TimeoutError("the listener has not heard of the end of the query")
            return self._sum()


def counted(df: DataFrame, name: str, **figures: Column) -> DataFrame:
    """The same rows, with figures (aggregates of whole numbers) taken on the way."""
    return df.observe(name, *[c.alias(k) for k, c in figures.items()])


def counters_frame(spark: SparkSession, totals: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(totals.items()), "counter STRING, n BIGINT")


def where_count(condition: Column) -> Column:
    """How many rows meet a condition."""
    return F.sum(F.when(condition, 1).otherwise(0))
