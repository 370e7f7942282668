"""Batch view of watermarks: what each row would have met in its order of arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparkloom.functions.time import duration_micros, interval
from sparkloom.operators.running import SLICE_ROWS, running

TICK = 1_000      # microseconds: a watermark stays one millisecond behind


def watermark_audit(df: DataFrame, time: str, arrival: Sequence[str], bound: str, *,
                    rows: int = SLICE_ROWS) -> DataFrame:
    """The watermark right after each row: highest time so far - bound - 1 ms."""
    seen = running(df, [], arrival, {"max_time": ("max", time)}, rows=rows)
    return seen.withColumn("watermark", F.col("max_time") - interval(duration_micros(bound) + TICK))


def tag_lateness(df: DataFrame, time: str, arrival: Sequence[str], length: str, bound: str,
                 lateness: str = "0 seconds", *, rows: int = SLICE_ROWS) -> DataFrame:
    """Add the row's window and how it met the window when it arrived.

    ``on_time``: still open. ``update``: fired already, but within the allowed lateness, so it
    fires again. ``late``: beyond; such rows are the side output.
    """
    seen = running(df, [], arrival, {"__max": ("max", time)}, inclusive=False, rows=rows)
    start = F.window(time, length).getField("start")
    end = F.col("window_start") + F.expr(f"INTERVAL {length}")
    progress = F.col("__max") - interval(duration_micros(bound))
    status = (F.when(progress.isNull() | (progress < F.col("window_end")), "on_time")
              .when(progress < F.col("window_end") + interval(duration_micros(lateness)), "update")
              .otherwise("late"))
    return (seen.withColumn("window_start", start).withColumn("window_end", end)
            .withColumn("lateness", status).drop("__max"))


def lateness_totals(tagged: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Final window results with allowed lateness: late rows are left out, and counted."""
    kept = F.col("lateness") != "late"
    return (tagged.groupBy(*keys, "window_start", "window_end")
            .agg(F.sum(F.when(kept, F.col(value)).otherwise(0)).alias("total"),
                 F.count_if(F.col("lateness") == "on_time").alias("n_on_time"),
                 F.count_if(F.col("lateness") == "update").alias("n_updates"),
                 F.count_if(~kept).alias("n_late")))
