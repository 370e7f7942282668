"""Changelog rows of a keyed total: withdraw the old result, add the new one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparkloom.operators.running import SLICE_ROWS, running


def changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, *,
              total: str = "total", rows: int = SLICE_ROWS) -> DataFrame:
    """For every input row ``(false, old total)`` if there was one, then ``(true, new total)``.

    ``step`` orders the two rows of one input.
    """
    traced = running(df, keys, order, {"__new": ("sum", value), "__n": ("count", None)}, rows=rows)
    new = F.struct(F.lit(2).alias("step"), F.lit(True).alias("is_add"), F.col("__new").alias(total))
    old = F.struct(F.lit(1).alias("step"), F.lit(False).alias("is_add"),
                   (F.col("__new") - F.col(value)).alias(total))
    both = F.when(F.col("__n") == 1, F.array(new)).otherwise(F.array(old, new))
    return traced.select(*dict.fromkeys([*keys, *order]), F.inline(both))
