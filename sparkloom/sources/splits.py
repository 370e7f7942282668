"""A log in several splits, each with an offset of its own in the checkpoint of the query.

Splits are dealt over the tasks anew whenever a micro-batch is planned, so a query goes on with more or
fewer tasks than before, and with splits that were added. ``rows_per_batch`` bounds a micro-batch: offsets
only move that far from where the last planned micro-batch ended. That place is kept in a small file, since
a restarted source learns its start only after it has been asked for the end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from sparkloom.files import read_bytes, replace_bytes, store_of


def write_splits(df: DataFrame, path: str, splits: int, by: Column, order: str) -> None:
    """Append a table to a log of ``splits`` splits, each in order, dealt by a hash of ``by``."""
    split = F.pmod(F.xxhash64(by), F.lit(splits)).cast("int").alias("split")
    (df.select(*df.columns, split).repartition("split").sortWithinPartitions("split", order)
     .write.mode("append").partitionBy("split").parquet(path))


def read_splits(spark: SparkSession, path: str, schema: StructType, cursor: str, tasks: int,
                rows_per_batch: int) -> DataFrame:
    """The log as a stream. ``cursor`` is a file that belongs to the query's checkpoint."""
    spark.dataSource.register(SplitLog)
    return (spark.readStream.format("split_log").schema(schema).option("path", path)
            .option("cursor", cursor).option("tasks", tasks).option("rows_per_batch", rows_per_batch)
            .load())


class SplitLog(DataSource):
    """Options ``path``, ``cursor``, ``tasks`` and ``rows_per_batch`` as in ``read_splits``."""

    @classmethod
    def name(cls) -> str:
        return "split_log"

    def streamReader(self, schema: StructType):
        return SplitReader(self.options, schema)


class Spans(InputPartition):
    """What one task reads: ``(split, first row, row behind the last)``."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.spans = spans


def advance(known: dict[str, int], present: dict[str, int], most: int) -> dict[str, int]:
    """New offsets: ``most`` rows further at most, dealt evenly over the splits that have more."""
    ends = {split: known.get(split, 0) for split in present}
    left = most
    while left > 0:
        behind = [s for s in sorted(present) if ends[s] < present[s]]
        if not behind:
            break
        share = max(1, left // len(behind))
        for split in behind[:left]:
            step = min(present[split] - ends[split], share)
            ends[split] += step
            left -= step
    return ends


class SplitReader(DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        self.path, self.cursor = options["path"], options["cursor"]
        self.tasks, self.most = int(options.get("tasks", 2)), int(options.get("rows_per_batch", 1 << 20))
        self.names = schema.names
        self._sizes: dict[str, int] = {}      # rows of a file, which never change

    def _files(self, split: str | None = None) -> list[tuple[str, str, int]]:
        """``(split, file, rows)`` in order."""
        store, root = store_of(self.path)
        below = f"{root}/split={split}" if split is not None else root
        found = []
        for info in store.get_file_info(fs.FileSelector(below, recursive=split is None)):
            if info.type == fs.FileType.File and info.base_name.endswith(".parquet"):
                if info.path not in self._sizes:
                    self._sizes[info.path] = pq.read_metadata(info.path, filesystem=store).num_rows
                found.append((info.path.rpartition("split=")[2].split("/")[0], info.mtime, info.path))
        return [(s, path, self._sizes[path]) for s, _, path in sorted(found)]

    def initialOffset(self) -> dict:
        return {split: 0 for split, _, _ in self._files()}

    def latestOffset(self) -> dict:
        present: dict[str, int] = {}
        for split, _, rows in self._files():
            present[split] = present.get(split, 0) + rows
        return advance(json.loads(read_bytes(self.cursor) or b"{}"), present, self.most)

    def partitions(self, start: dict, end: dict) -> list[Spans]:
        replace_bytes(self.cursor, json.dumps(end).encode())
        spans = [(s, start.get(s, 0), end[s]) for s in sorted(end) if end[s] > start.get(s, 0)]
        return [Spans(spans[k::self.tasks]) for k in range(self.tasks) if spans[k::self.tasks]]

    def read(self, partition: Spans) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.path)
        for split, first, last in partition.spans:
            at = 0
            for _, path, rows in self._files(split):
                if at < last and at + rows > first:
                    yield from self._slice(store, path, first - at, last - at)
                at += rows

    def _slice(self, store, path: str, first: int, last: int) -> Iterator[pa.RecordBatch]:
        """Rows of one file, reading only the row groups that have them."""
        with store.open_input_file(path) as handle:
            file, at = pq.ParquetFile(handle), 0
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if at < last and at + rows > first:
                    part = file.read_row_group(group, columns=self.names).select(self.names)
                    begin = max(0, first - at)
                    yield from part.slice(begin, min(rows, last - at) - begin).to_batches()
                at += rows

    def commit(self, end: dict) -> None:
        """The checkpoint holds the offsets; nothing to release."""
