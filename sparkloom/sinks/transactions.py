"""A sink that publishes a micro-batch at its commit: all of its files, once, or none.

Tasks write files that nobody sees and report their names; the driver's commit names them in one
manifest per micro-batch, which is moved into place. A micro-batch that runs again finds its manifest and
throws its second set of files away. Files of tasks that died are in no manifest; ``sweep`` removes them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from sparkloom.files import read_bytes, replace_bytes, store_of

DATA, COMMITTED = "data", "committed"     # folders below the path; no leading underscore, Spark reads both


@dataclass
class Written(WriterCommitMessage):
    file: str | None     # None from a task without rows
    rows: int = 0


class CommittedFiles(DataSource):
    """Option ``path``: a folder that driver and executors share and ``pyarrow.fs`` can reach."""

    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def streamWriter(self, schema: StructType, overwrite: bool):
        return StagedWriter(self.options["path"].rstrip("/"))


class StagedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> Written:
        store, folder = store_of(f"{self.path}/{DATA}")
        store.create_dir(folder, recursive=True)
        file, writer, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        writer = pq.ParquetWriter(f"{folder}/{file}", batch.schema, filesystem=store)
                    writer.write_table(pa.Table.from_batches([batch]))
                    rows += batch.num_rows
            if writer is not None:
                writer.close()
        except BaseException:
            if writer is not None:
                writer.close()
                store.delete_file(f"{folder}/{file}")
            raise
        return Written(file if rows else None, rows)

    def manifest(self, batch_id: int) -> str:
        return f"{self.path}/{COMMITTED}/{batch_id:012d}.json"

    def commit(self, messages, batchId: int) -> None:
        """Publish; the files of a micro-batch that was published before go."""
        if read_bytes(self.manifest(batchId)) is not None:
            self.abort(messages, batchId)
            return
        lines = [json.dumps({"batch_id": batchId, "file": m.file, "n_rows": m.rows})
                 for m in messages if m is not None and m.file]
        replace_bytes(self.manifest(batchId), "\n".join(lines).encode())

    def abort(self, messages, batchId: int) -> None:
        store, folder = store_of(f"{self.path}/{DATA}")
        for message in messages:
            if message is not None and message.file:
                try:
                    store.delete_file(f"{folder}/{message.file}")
                except FileNotFoundError:
                    pass


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, file, n_rows)`` of all published files."""
    return spark.read.schema("batch_id BIGINT, file STRING, n_rows BIGINT").json(f"{path}/{COMMITTED}")


def read_committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The published rows. The names of the files go through the driver, as with any file table."""
    files = [f"{path}/{DATA}/{row.file}" for row in manifests(spark, path).select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def sweep(spark: SparkSession, path: str, older_than: float = 86_400.0) -> int:
    """Remove files that no manifest names and that are older (in seconds). Returns how many."""
    named = {row.file for row in manifests(spark, path).select("file").collect()}
    store, folder = store_of(f"{path}/{DATA}")
    before = time.time() - older_than
    gone = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            if f.base_name not in named and f.mtime is not None and f.mtime.timestamp() < before]
    for file in gone:
        store.delete_file(file)
    return len(gone)
