"""First-visit and new-in-period flags of a visitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparkloom.functions.time import GRAIN_PATTERNS, later_at_grain
from sparkloom.operators.running import SLICE_ROWS, running

FLAGS = ("is_new", *[f"is_{grain}_new" for grain in GRAIN_PATTERNS])


def flag_columns(current: str, previous: str, zone: str = "UTC") -> dict:
    """All flags are 1 on a first visit; later, a grain's flag is 1 when its period moved on."""
    first = F.col(previous).isNull()
    flags = {"is_new": first.cast("int")}
    for grain in GRAIN_PATTERNS:
        moved = later_at_grain(current, previous, grain, zone)
        flags[f"is_{grain}_new"] = F.when(first, 1).otherwise(moved)
    return flags


def newness(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], *,
            remember: str = "last", zone: str = "UTC", rows: int = SLICE_ROWS) -> DataFrame:
    """Flags of every visit against the visit remembered for its keys.

    ``remember="last"`` keeps the visit just before in ``order``, even if its time is older;
    ``"max"`` keeps the latest time seen, so late rows do not set a visitor back.
    """
    kind = {"last": "last", "max": "max"}[remember]
    seen = running(df, keys, order, {"__seen": (kind, time)}, inclusive=False, rows=rows)
    return seen.withColumns(flag_columns(time, "__seen", zone)).drop("__seen")
