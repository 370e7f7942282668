"""Text and dated files."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def output_path(args: Sequence[str], default_root: str) -> str:
    """The value after ``--output``, else a folder named by the time."""
    args = list(args)
    if "--output" in args[:-1]:
        return args[args.index("--output") + 1]
    return f"{default_root}/wordcount/output_{int(time.time() * 1000)}"


def write_text(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Replace a folder of text files; ``parts`` files when given, else one per task.

    A low number of parts merges tasks without a shuffle and so limits the parallelism of what
    comes before; leave it out for large results.
    """
    (df.coalesce(parts) if parts else df).write.mode("overwrite").text(path)


def file_stream(df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                every: str | None = None, max_rows_per_file: int | None = None,
                partition_by: Sequence[str] = ()):
    """Writer of files that hold every row exactly once, across restarts.

    A file rolls with each micro-batch (``every``) or at a number of rows.
    """
    writer = (df.writeStream.outputMode("append").format(fmt).option("path", path)
              .option("checkpointLocation", checkpoint))
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(processingTime=every) if every else writer


def with_date(df: DataFrame, time_col: str | Column | None = None, name: str = "dt") -> DataFrame:
    """Add the ``yyyy-MM-dd`` bucket: by a column, or by the date of processing."""
    when = F.current_timestamp() if time_col is None else (
        F.col(time_col) if isinstance(time_col, str) else time_col)
    return df.withColumn(name, F.date_format(when, "yyyy-MM-dd"))


def write_dated(df: DataFrame, path: str, time_col: str | None = None, fmt: str = "parquet",
                max_rows_per_file: int = 0) -> None:
    """Batch files in one folder per date.

    Rows of a date meet in few tasks, so there are few files; the rebalance splits dates that are
    too big for one task. ``max_rows_per_file`` splits files further.
    """
    dated = with_date(df, time_col).hint("rebalance", F.col("dt"))
    writer = dated.write.mode("overwrite").partitionBy("dt")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.format(fmt).save(path)
