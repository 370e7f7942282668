"""Row-by-row actions with a life cycle, for stores without a Spark connector."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


class RowWriter:
    """For ``writeStream.foreach``: connect once per task and micro-batch, act, close.

    ``connect(partition, epoch)`` returns an object with ``write(row)`` and ``close()``.
    """

    def __init__(self, connect: Callable):
        self.connect = connect

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.target = self.connect(partition_id, epoch_id)
        return True

    def process(self, row) -> None:
        self.target.write(row)

    def close(self, error) -> None:
        if getattr(self, "target", None) is not None:
            self.target.close()


def for_each_task(df: DataFrame, connect: Callable) -> None:
    """The same on a batch: one connection per task."""
    def run(rows: Iterable) -> None:
        target = connect()
        try:
            for row in rows:
                target.write(row)
        finally:
            target.close()
    df.foreachPartition(run)
