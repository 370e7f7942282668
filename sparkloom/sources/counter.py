"""A counter that can be read again from any offset.

Spark keeps the offset in the checkpoint of the query, so a restarted query goes on after the
last committed batch. Rows are made inside the tasks; the driver handles two numbers per batch.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class CounterSource(DataSource):
    """Options: ``total`` rows in all, ``per_second`` since ``since`` (epoch seconds), ``tasks``."""

    @classmethod
    def name(cls) -> str:
        return "counter"

    def schema(self) -> str:
        return "value BIGINT, task INT"

    def streamReader(self, schema):
        return CounterReader(self.options)


class Span(InputPartition):
    def __init__(self, task: int, tasks: int, start: int, end: int):
        self.task, self.tasks, self.start, self.end = task, tasks, start, end


class CounterReader(DataSourceStreamReader):
    def __init__(self, options):
        self.total = int(options.get("total", 1 << 62))
        self.per_second = float(options.get("per_second", 1))
        self.since = float(options.get("since", time.time()))
        self.tasks = int(options.get("tasks", 2))

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        due = int((time.time() - self.since) * self.per_second)
        return {"next": max(0, min(self.total, due))}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return [Span(i, self.tasks, start["next"], end["next"]) for i in range(self.tasks)]

    def read(self, partition: Span) -> Iterator[tuple]:
        first = partition.start + (partition.task - partition.start) % partition.tasks
        for value in range(first, partition.end, partition.tasks):
            yield (value, partition.task)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the offset; nothing to release."""
