"""Exactly-once results of micro-batches.

A failed micro-batch is run again with the same id and the same rows. Each batch owns one folder
and replaces it, so a second run leaves no trace of a first, half-done one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def write_once(root: str, prepare: Callable[[DataFrame], DataFrame] | None = None,
               fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").format(fmt).save(batch_folder(root, batch_id))
    return write


def read_batches(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All rows; ``batch_id`` is a column that filters whole folders."""
    return spark.read.format(fmt).load(root)
