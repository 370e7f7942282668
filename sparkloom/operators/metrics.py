"""Counters of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def counted(df: DataFrame, name: str = "counter", *more: Column) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs; read the ``Observation`` after that action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *more), seen
