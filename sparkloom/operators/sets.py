"""Unions of two inputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    """All rows of same-typed inputs; duplicates stay."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_distinct(*parts: DataFrame) -> DataFrame:
    """SQL UNION. Duplicates are dropped map-side before the shuffle."""
    return union_all(*parts).distinct()


def map_to_common(left: DataFrame, left_map: Mapping, right: DataFrame,
                  right_map: Mapping) -> DataFrame:
    """Two inputs of different types, each mapped to the same columns, as one."""
    def project(df: DataFrame, columns: Mapping) -> DataFrame:
        return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n)
                           for n, c in columns.items()])
    return project(left, left_map).unionByName(project(right, right_map))
