"""Running aggregates of a stream without Python state.

Each micro-batch runs the batch operator, which cuts busy keys into slices, and adds what earlier
batches left in a keyed table. Results and table are both fenced by the batch id, so a batch that
runs again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from sparkloom.operators.running import SLICE_ROWS, running
from sparkloom.sinks.batches import batch_folder
from sparkloom.sinks.keyed import ADD, HIGHEST, LOWEST, KeyedTable

_RULES = {"sum": ADD, "count": ADD, "max": HIGHEST, "min": LOWEST}


class Traced:
    """``deliver`` is for ``foreachBatch``; results are under ``<root>/out``."""

    def __init__(self, df: DataFrame, root: str, keys: Sequence[str], order: Sequence[str],
                 measures: dict, *, inclusive: bool = True, rows: int = SLICE_ROWS,
                 compact_every: int = 50):
        self.root, self.keys, self.order = root, list(keys), list(order)
        self.measures, self.inclusive, self.rows = measures, inclusive, rows
        self.compact_every = compact_every
        types = {n: "BIGINT" if kind == "count" or (
            kind == "sum" and df.schema[col].dataType.typeName() in ("integer", "long"))
            else df.schema[col].dataType.simpleString() for n, (kind, col) in measures.items()}
        self.table = KeyedTable(
            df.sparkSession, f"{root}/totals",
            ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in self.keys),
            ", ".join(f"{n} {kind}" for n, kind in types.items()),
            {n: _RULES[kind] for n, (kind, _) in measures.items()})

    def deliver(self, batch: DataFrame, batch_id: int) -> None:
        # Several passes follow; the micro-batch is kept so that its source is read once.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._deliver(kept, batch_id)
        finally:
            kept.unpersist()

    def _deliver(self, batch: DataFrame, batch_id: int) -> None:
        traced = running(batch, self.keys, self.order, self.measures, inclusive=self.inclusive,
                         rows=self.rows)
        before = self.table.read(before=batch_id)
        before = before.select(*[F.col(k).alias(f"__k_{k}") for k in self.keys],
                               *[F.col(n).alias(f"__before_{n}") for n in self.measures])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        combined = {n: self._combine(kind, F.col(n), F.col(f"__before_{n}"))
                    for n, (kind, _) in self.measures.items()}
        (traced.join(before, same, "left").withColumns(combined)
         .select(*batch.columns, *self.measures)
         .write.mode("overwrite").parquet(batch_folder(f"{self.root}/out", batch_id)))
        self.table.upsert(batch.select(*self.keys, *[
            self._input(kind, col).alias(n) for n, (kind, col) in self.measures.items()]), batch_id)
        if batch_id and batch_id % self.compact_every == 0:
            self.table.compact(batch_id)

    @staticmethod
    def _input(kind: str, col):
        if kind != "count":
            return F.col(col)
        return F.lit(1).cast("long") if col is None else F.col(col).isNotNull().cast("long")

    @staticmethod
    def _combine(kind: str, now, before):
        if kind == "max":
            return F.greatest(now, before)
        if kind == "min":
            return F.least(now, before)
        return F.when(now.isNull(), before).when(before.isNull(), now).otherwise(now + before)


def traced_batches(df: DataFrame, root: str, run: Callable, **spec) -> DataFrame:
    """Run ``Traced`` over a stream with ``run(df, deliver)`` and return the rows it wrote."""
    traced = Traced(df, root, **spec)
    run(df, traced.deliver)
    return df.sparkSession.read.parquet(f"{root}/out").drop("batch_id")
