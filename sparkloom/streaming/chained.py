"""Aggregates of aggregates in one stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def window_of_windows(windows: DataFrame, length: str, *keys: str | Column, measures: list[Column],
                      offset: str | None = None) -> DataFrame:
    """Longer windows over the results of shorter ones, which carry their ``window`` column.

    ``window_time`` gives each result the last instant of its window as its event time; the
    watermark of the first aggregate then closes the second one too. Append mode.
    """
    at = F.window_time("window")
    longer = F.window(at, length, startTime=offset) if offset else F.window(at, length)
    return windows.groupBy(longer.alias("window"), *keys).agg(*measures)


def daily_top(rows: DataFrame, time: str, category: str, amount: str, most: int = 3,
              offset: str | None = None) -> DataFrame:
    """Hourly totals per category, daily totals of these, and each day's total and highest categories.

    Three aggregates in one query on one watermark; a day is given once it has closed. ``amount`` is a
    whole number. A day's list holds one entry per category until it is cut to ``most``; of equal
    totals the smaller name comes first.
    """
    hourly = rows.groupBy(F.window(time, "1 hour").alias("window"), category).agg(
        F.sum(amount).alias("total"))
    daily = window_of_windows(hourly, "1 day", category, measures=[F.sum("total").alias("total")],
                              offset=offset)
    entry = F.struct((-F.col("total")).alias("less"), F.col(category).alias("name"))
    listed = window_of_windows(daily, "1 day", measures=[
        F.sum("total").alias("total"), F.sort_array(F.collect_list(entry)).alias("all")], offset=offset)
    top = F.slice("all", 1, most)
    return listed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total",
        F.transform(top, lambda e: e["name"]).alias("top_names"),
        F.transform(top, lambda e: -e["less"]).alias("top_totals"))
