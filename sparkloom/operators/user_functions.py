"""User code on rows, in Arrow batches. Built-in column functions come first; these are for what
they cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.text import as_col


def map_values(fn: Callable[..., pd.Series], kind: str, *cols: str | Column) -> Column:
    """A new column from a function of whole batches of other columns."""
    def run(*series: pd.Series) -> pd.Series:
        return fn(*series)
    # Annotations of a variable argument list cannot be read, so the kind is named.
    return F.pandas_udf(run, kind, F.PandasUDFType.SCALAR)(*[as_col(c) for c in cols])


def keep_rows(df: DataFrame, fn: Callable[..., pd.Series], *cols: str) -> DataFrame:
    """Rows for which a function of whole batches is true."""
    return df.where(map_values(fn, "boolean", *cols))


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], Iterator[pd.DataFrame]],
             schema: str) -> DataFrame:
    """Any number of rows for each batch; ``fn`` yields frames, so output may exceed memory."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from fn(frame)
    return df.mapInPandas(run, schema)


def map_with_resource(df: DataFrame, open_: Callable[[], object],
                      fn: Callable[[object, pd.DataFrame], pd.DataFrame],
                      schema: str) -> DataFrame:
    """Batches through something opened once per task, such as a client or a model.

    It is closed at the end of the task if it has ``close``.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for frame in frames:
                yield fn(resource, frame)
        finally:
            if hasattr(resource, "close"):
                resource.close()
    return df.mapInPandas(run, schema)
