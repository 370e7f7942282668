"""Event time and watermarks of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkloom.functions.time import duration_micros, millis_to_instant
from sparkloom.tables import instant


def event_time(df: DataFrame, time: str, bound: str, millis: bool = False) -> DataFrame:
    """Bounded disorder: rows may come up to ``bound`` after a later one."""
    column = millis_to_instant(time) if millis else instant(time)
    return df.withColumn(time, column).withWatermark(time, bound)


def arrival_time(df: DataFrame, name: str = "ts") -> DataFrame:
    """Wall-clock event time; such rows are never out of order."""
    return df.withColumn(name, F.current_timestamp()).withWatermark(name, "0 seconds")


def with_lateness(df: DataFrame, time: str, bound: str, lateness: str) -> DataFrame:
    """Watermark for windows that also take rows up to ``lateness`` after firing.

    In update mode every change of a window emits it again until bound + lateness have passed.
    """
    total = duration_micros(bound) + duration_micros(lateness)
    return event_time(df, time, f"{total // 1000} milliseconds")


def progress(query: StreamingQuery) -> list[dict]:
    """Event time seen and watermark in force, per micro-batch."""
    return [{"batch": p["batchId"], **p["eventTime"]} for p in query.recentProgress]
