"""How rows are spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.operators.joins import broadcast_if_small


def by_key(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """Hash partitioning; a following join or aggregation on the keys needs no other shuffle."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def single(df: DataFrame) -> DataFrame:
    """Everything to one partition. For results that are small by construction only."""
    return df.repartition(1)


def to_every_task(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """A copy for every task: meaningful as one side of a join, and only below a checked size."""
    return broadcast_if_small(df, max_rows)


def in_place(df: DataFrame) -> DataFrame:
    """Rows stay in their task."""
    return df


def spread_random(df: DataFrame, n: int, seed: int = 0, unique: Sequence[str] = ()) -> DataFrame:
    """Scatter rows without regard to their content.

    With a ``unique`` key the target is a seeded hash of it, so a task that is run again after a
    lost executor sends each row to the same place; a random draw would not. Without one, rows
    go round robin, which evens out even if many rows are copies.
    """
    return df.repartition(n, F.xxhash64(F.lit(seed), *unique)) if unique else df.repartition(n)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round robin: even partitions whatever the keys."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int, grow: bool = False) -> DataFrame:
    """Fewer partitions by joining neighbours, without a shuffle; ``grow`` adds some instead."""
    return df.repartition(n) if grow else df.coalesce(n)


def by_rule(df: DataFrame, n: int, target: Column) -> DataFrame:
    """Custom partitioner: ``target`` is the partition number of each row."""
    return df.repartitionById(n, target.cast("int"))


def rows_per_partition(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.spark_partition_id().alias("partition"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
