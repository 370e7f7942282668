"""Several outputs from one read of a micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame

from sparkloom.operators.rows import route
from sparkloom.sinks.batches import batch_folder


def routed_batches(routes: Mapping[str, Column], root: str,
                   prepare: Callable[[DataFrame], DataFrame] | None = None):
    """For ``foreachBatch``: each tag's rows go to ``<root>/<tag>/batch_id=N``.

    The micro-batch is kept on memory or disk while its outputs are written, so it is read and
    computed once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = (prepare(batch) if prepare else batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for tag, part in route(rows, routes).items():
                part.write.mode("overwrite").parquet(batch_folder(f"{root}/{tag}", batch_id))
        finally:
            rows.unpersist()
    return write
