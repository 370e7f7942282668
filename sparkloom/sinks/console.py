"""Printing."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame


def show(df: DataFrame, label: str | None = None, *, n: int, err: bool = False) -> None:
    """Preview of a batch: print its first ``n`` rows, to stderr on request."""
    rows = df.take(n)
    out = sys.stderr if err else sys.stdout
    for row in rows:
        print(f"{label}> {row}" if label else row, file=out)


def console_stream(df: DataFrame, label: str | None = None, mode: str = "append", *, n: int):
    """Writer that prints up to ``n`` rows of every micro-batch; the label names the query."""
    writer = (df.writeStream.outputMode(mode).format("console").option("truncate", False)
              .option("numRows", n))
    return writer.queryName(label) if label else writer
