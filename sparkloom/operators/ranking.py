"""Top-k and the two-level dashboard aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkloom.functions.numbers import round_half_up
from sparkloom.operators.windows import window_totals


def top_per_group(df: DataFrame, group: Sequence[str], by: str, tie: str, k: int,
                  name: str = "rank") -> DataFrame:
    """The k highest rows per group; ``tie`` (ascending) makes equal values repeatable.

    The rank filter reaches below the shuffle as a group limit: each task sends at most k rows
    per group, so a busy group is no bottleneck.
    """
    order = Window.partitionBy(*group).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def top(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k highest rows of all, sorted: a per-task heap, no global sort."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def exact_sum(amount: str, decimals: int | None = None) -> Column:
    """Sum of amounts. With ``decimals`` given (the amounts have no more), they are added as whole
    numbers: exact in any order, so every run gives the same total."""
    if decimals is None:
        return F.sum(amount)
    unit = 10 ** decimals
    return F.sum(F.round(F.col(amount) * unit).cast("long")) / F.lit(float(unit))


def category_totals(df: DataFrame, category: str, amount: str, time: str, *,
                    length: str = "1 day", offset: str | None = None,
                    decimals: int | None = None) -> DataFrame:
    """First level: ``total`` per category and window."""
    return window_totals(df, time, length, [category],
                         [exact_sum(amount, decimals).alias("total")], offset=offset)


def dashboard(totals: DataFrame, category: str, k: int = 3) -> DataFrame:
    """Second level: grand total per window and its k best categories as text lines."""
    window = ["window_start", "window_end"]
    grand = totals.groupBy(*window).agg(round_half_up(F.sum("total")).alias("total"))
    best = top_per_group(totals, window, "total", category, k)
    # At most k rows per window are collected.
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct("rank", F.col(category).alias("c"), "total"))),
        lambda x: F.concat(x["c"].cast("string"), F.lit("="),
                           x["total"].cast("decimal(18,2)").cast("string")))
    listed = best.groupBy(*window).agg(F.array_join(lines, "\n").alias("top_categories"))
    return grand.join(listed, window).select(*window, "total", "top_categories")
