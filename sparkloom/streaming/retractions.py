"""Aggregates over a changelog: rows that are added and rows that are withdrawn."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

SUMMARY = "n BIGINT, total BIGINT, lowest BIGINT, highest BIGINT"


class Retracting(StatefulProcessor):
    """A multiset of values per key, and what it amounts to.

    The multiset is needed for the extremes: when the last copy of one goes, the next is looked for.
    """

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.copies = handle.getMapState("copies", "value BIGINT", "n BIGINT")
        self.summary = handle.getValueState("summary", SUMMARY)

    def handleInputRows(self, key, rows, timerValues):
        was = tuple(self.summary.get()) if self.summary.exists() else (0, 0, None, None)
        n, total, lowest, highest = was
        gone = False
        changes: dict[int, int] = {}
        for row in rows:
            changes[row["__value"]] = changes.get(row["__value"], 0) + row["__copies"]
        for value, change in changes.items():
            if not change:
                continue
            held = self.copies.getValue((value,))
            left = (held[0] if held else 0) + change
            if left:
                self.copies.updateValue((value,), (left,))
            else:
                self.copies.removeKey((value,))
            n, total = n + change, total + change * value
            if left <= 0:
                gone = gone or value in (lowest, highest)
            else:
                lowest = value if lowest is None else min(lowest, value)
                highest = value if highest is None else max(highest, value)
        if gone:
            values = [k[0] for k, v in self.copies.iterator() if v[0] > 0]
            lowest, highest = (min(values), max(values)) if values else (None, None)
        now = (n, total, lowest, highest)
        if now != was:
            self.summary.update(now)
            yield Row(*self.names)(*key, *now)

    def close(self) -> None:
        pass


def net_changes(df: DataFrame, keys: Sequence[str], value: str, is_add: str) -> DataFrame:
    """``(keys, __value, __copies)``: added minus withdrawn copies, folded per task and micro-batch."""
    names = list(keys)
    ready = df.select(*keys, F.col(value).cast("long").alias("__value"),
                      F.when(F.col(is_add), 1).otherwise(-1).cast("long").alias("__copies"))

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            net = frame.groupby([*names, "__value"], sort=False, dropna=False, as_index=False)["__copies"].sum()
            yield net[net["__copies"] != 0]
    return ready.mapInPandas(fold, ready.schema)


def retracting_summary(changes: DataFrame, keys: Sequence[str], value: str, is_add: str) -> DataFrame:
    """Count, sum, lowest and highest of a whole-number column over the rows that are in force.

    ``changes`` has one row per addition (``is_add``) or withdrawal. Each micro-batch gives one row per key
    whose summary has changed, so the last row of a key holds; ``n`` is 0 once all is withdrawn. The rows of a
    micro-batch are netted first, so their order does not matter. Null values are left out.
    """
    schema = StructType([changes.schema[k] for k in keys])
    for part in SUMMARY.split(", "):
        schema = schema.add(part.split()[0], "long")
    net = net_changes(changes.where(F.col(value).isNotNull()), keys, value, is_add)
    return net.groupBy(*keys).transformWithState(
        statefulProcessor=Retracting(schema.names), outputStructType=schema, outputMode="append",
        timeMode="None")
