"""Reading the parquet tables as bounded or unbounded DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stream_table(spark: SparkSession, root: str, name: str,
                 max_files: int | None = None) -> DataFrame:
    """The same table as a stream of its files, oldest first.

    The path is written as a glob because a file stream accepts a single file only in that form;
    a table that is a folder of part files matches the same glob.
    """
    reader = spark.readStream.schema(read_table(spark, root, name).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{root}/{name}.parque[t]")


def instant(col: str | Column) -> Column:
    """Wall-clock column as an instant; watermarks need TIMESTAMP (session zone is UTC)."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")


def wall_clock(col: str | Column) -> Column:
    """Instant column back to TIMESTAMP_NTZ for output."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
