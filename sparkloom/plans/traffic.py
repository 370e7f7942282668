"""Cars counted by sensors at traffic lights, from ``sensor,count`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkloom.operators.rows import parse_csv
from sparkloom.operators.windows import arrival_totals, session_totals, window_totals

LINE = "sensor STRING, count INT"


def cars(lines: DataFrame, line: str = "value") -> DataFrame:
    return parse_csv(lines, line, LINE)


def total() -> list:
    return [F.sum("count").alias("count")]


def tumbling(df: DataFrame, time: str, length: str = "5 seconds") -> DataFrame:
    return window_totals(df, time, length, ["sensor"], total())


def sliding(df: DataFrame, time: str, length: str = "10 seconds",
            slide: str = "5 seconds") -> DataFrame:
    return window_totals(df, time, length, ["sensor"], total(), slide=slide)


def sessions(df: DataFrame, time: str, gap: str = "10 seconds", **sizes) -> DataFrame:
    """Cars of a sensor until no car came for ``gap``."""
    return session_totals(df, time, gap, ["sensor"], {"count": ("sum", "count")}, **sizes)


def arriving(df: DataFrame, length: str = "5 seconds", slide: str | None = None) -> DataFrame:
    """Windows on the clock of the reader."""
    return arrival_totals(df, length, ["sensor"], total(), slide=slide)
