"""Projections, filters and row expansion; each works on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.text import as_col, contains_any, pair_text, split_fields
from sparkloom.functions.time import GRAIN_PATTERNS, in_zone


def words(df: DataFrame, text: str, out: str = "word", sep: str = " ") -> DataFrame:
    """One row per field of a text column."""
    return df.select(F.explode(split_fields(text, sep)).alias(out))


def keep_any(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose column equals one of the values."""
    return df.where(F.col(col).isin(list(values)))


def drop_containing(df: DataFrame, col: str, blocked: Sequence[str]) -> DataFrame:
    """Rows whose text holds none of the blocked words."""
    return df.where(~contains_any(col, list(blocked)))


def route(df: DataFrame, routes: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Side outputs: one filtered DataFrame per tag, each with its own pushed-down filter."""
    return {tag: df.where(condition) for tag, condition in routes.items()}


def tag_rows(df: DataFrame, routes: Mapping[str, Column], name: str = "tag",
             default: str | None = None) -> DataFrame:
    """The same split in one pass: the first matching tag as a column."""
    tag = F.lit(default)
    for label, condition in reversed(routes.items()):
        tag = F.when(condition, F.lit(label)).otherwise(tag)
    return df.withColumn(name, tag)


def parse_csv(df: DataFrame, line: str, schema: str) -> DataFrame:
    """Delimited lines to typed columns."""
    return df.select(F.from_csv(line, schema).alias("__row")).select("__row.*")


def as_pairs(df: DataFrame, left: str, right: str, sep: str = ":",
             name: str = "value") -> DataFrame:
    """Two columns as one ``left:right`` text."""
    return df.select(pair_text(left, right, sep=sep).alias(name))


def with_partition(df: DataFrame, name: str = "partition") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def expand_grains(df: DataFrame, time: str, per_grain: Mapping[str, Mapping[str, Column]],
                  keep: Sequence[str], zone: str = "UTC", name: str = "period") -> DataFrame:
    """One row per time grain (hour, day, month) from one scan.

    ``per_grain`` gives the measure columns of each grain.
    """
    local = in_zone(as_col(time), zone)
    rows = F.array(*[
        F.struct(F.date_format(local, GRAIN_PATTERNS[grain]).alias(name),
                 *[c.alias(n) for n, c in measures.items()])
        for grain, measures in per_grain.items()])
    return df.select(*keep, F.inline(rows))


def view_of(df: DataFrame, name: str, *columns: str | Column) -> DataFrame:
    """Register chosen columns as a temporary view and return it as a table."""
    (df.select(*columns) if columns else df).createOrReplaceTempView(name)
    return df.sparkSession.table(name)
