"""Running, restarting and replaying streaming queries."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkloom.session import settings, shared_dir
from sparkloom.sinks.batches import write_once

# For inner joins of streams. They emit nothing in a micro-batch without rows, which would only go through all
# of the state once more; what is too old leaves with the next rows instead. To know the number of rows in the
# state, every write looks its key up first; without, ``numRowsTotal`` in the progress tells nothing.
INNER_JOIN = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append rows to files until all present input is read. Starts the query."""
    return (df.writeStream.outputMode("append").format(fmt).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def to_batches(df: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to ``deliver`` until all present input is read."""
    return (df.writeStream.outputMode(mode).foreachBatch(deliver)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def live(df: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str,
         every: str = "1 second", mode: str = "update") -> StreamingQuery:
    """Keep running, with results of open windows at every tick: early firing."""
    return (df.writeStream.outputMode(mode).foreachBatch(deliver)
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def rounds(start: Callable[[int], StreamingQuery], most: int = 10_000) -> int:
    """Run a bounded query again and again, from one checkpoint, until a run finds no rows.

    For sources that hand out so many rows at a time. ``start`` takes the number of the run. Returns the runs.
    """
    for run in range(most):
        query = start(run)
        query.awaitTermination()
        if not sum(p["numInputRows"] for p in query.recentProgress):
            return run + 1
    raise RuntimeError(f"still rows after {most} runs")


def until_idle(query: StreamingQuery, timeout: float = 600.0, *, keep_state: bool = False) -> None:
    """Stop a query on the clock once it has read its input and, unless it may keep it, let go of all state."""
    limit = time.monotonic() + timeout
    try:
        while query.isActive:
            last = query.lastProgress
            read = last and not last["numInputRows"] and (keep_state or last["batchId"] > 0)
            if read and (keep_state or all(s["numRowsTotal"] == 0 for s in last["stateOperators"])):
                return
            if time.monotonic() > limit:
                raise TimeoutError("the query still holds state")
            time.sleep(0.2)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()


def finish(spark: SparkSession, df: DataFrame, label: str, mode: str = "append",
           conf: Mapping[str, str] | None = None) -> DataFrame:
    """Run a stream over its present input and return what it emitted, as a table on shared
    storage: append results through the file sink, others one folder per micro-batch. ``conf``
    holds settings of this query alone."""
    root = shared_dir(spark, label)
    with settings(spark, conf or {}):
        if mode == "append":
            query = to_files(df, f"{root}/out", f"{root}/checkpoint")
        else:
            query = to_batches(df, write_once(f"{root}/out"), f"{root}/checkpoint", mode)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out").select(*df.columns)


def run_with_restart(start: Callable[[], StreamingQuery], attempts: int = 3,
                     delay: float = 5.0) -> int:
    """Fixed-delay restart. ``start`` must reuse one checkpoint. Returns the restarts needed."""
    for restarts in range(attempts + 1):
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            if restarts == attempts:
                raise
            time.sleep(delay)
    raise AssertionError("unreachable")


def run_with_failure_rate(start: Callable[[], StreamingQuery], failures: int = 3,
                          within: float = 60.0, delay: float = 3.0) -> int:
    """Restart until more than ``failures`` fall into any ``within`` seconds."""
    recent: deque[float] = deque()
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException:
            now = time.monotonic()
            recent.append(now)
            while now - recent[0] > within:
                recent.popleft()
            if len(recent) > failures:
                raise
            restarts += 1
            time.sleep(delay)


def replay(df: DataFrame, path: str, cuts: Sequence, by: str, max_files: int = 1) -> DataFrame:
    """Write a table as ordered pieces and read them back as a stream, a piece per micro-batch.

    ``cuts`` are the bounds of the pieces on column ``by``; a trial aid, not for large tables.
    """
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = df
        if low is not None:
            part = part.where(F.col(by) >= F.lit(low))
        if high is not None:
            part = part.where(F.col(by) < F.lit(high))
        part.coalesce(1).write.mode("append").parquet(path)
    return (df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", max_files)
            .parquet(path))
