"""Small inputs given in code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F


def elements(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """Literal rows; single values are allowed for one-column schemas."""
    return spark.createDataFrame(
        [row if isinstance(row, (tuple, list, dict)) else (row,) for row in rows], schema)


def sequence(spark: SparkSession, first: int, last: int, parts: int | None = None) -> DataFrame:
    """All integers from ``first`` to ``last``, both included; made inside the tasks."""
    return (spark.range(first, last + 1, 1, parts) if parts else spark.range(first, last + 1)) \
        .withColumnRenamed("id", "value")


def constants(spark: SparkSession, *values) -> DataFrame:
    """One row of constants c1, c2, ..."""
    return spark.range(1).select(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(values, 1)])
