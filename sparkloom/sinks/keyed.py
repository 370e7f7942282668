"""Keyed tables on shared storage: the rows of a stream merged per key.

Every micro-batch adds one folder of changes, pre-aggregated to a row per key, whose name is the
batch id; a batch that runs again replaces its own folder, so nothing is counted twice. Reading
merges the changes. ``compact`` writes the merged rows as a new base and then records it in a
log, so readers move from one complete base to the next. Writing a batch costs as much as the
batch, not as much as the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# How stored and new value of a column merge.
ADD, REPLACE, HIGHEST, LOWEST = "add", "replace", "highest", "lowest"
_MERGE = {ADD: F.sum, HIGHEST: F.max, LOWEST: F.min}


class KeyedTable:
    """``keys`` and ``columns`` are DDL; ``rules`` gives the merge rule of each value column."""

    def __init__(self, spark: SparkSession, root: str, keys: str, columns: str,
                 rules: Mapping[str, str]):
        self.spark, self.root, self.rules = spark, root, dict(rules)
        schema = f"{keys}, {columns}"
        nothing = spark.range(0).select(F.lit("{}").alias("row"))
        empty = nothing.select(F.from_json("row", schema).alias("r")).select("r.*")
        self.columns = list(self.rules)
        self.keys = [c for c in empty.columns if c not in self.rules]
        self._types = dict(empty.dtypes)
        # Created if missing; "ignore" leaves an existing table alone.
        changes = empty.withColumn("__gone", F.lit(False))
        changes.write.mode("ignore").parquet(f"{root}/changes/batch_id=-1")
        self._note("base", -1, "ignore")

    # -- writing ---------------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, batch_id: int, order: str | None = None) -> None:
        """Merge rows. Several rows of a key merge first; ``order`` says which one replaces."""
        merged = rows.groupBy(*self.keys).agg(*[self._in_batch(c, order) for c in self.columns])
        self._write(merged.withColumn("__gone", F.lit(False)), batch_id)

    def delete(self, keys: DataFrame, batch_id: int) -> None:
        """Forget keys; later batches may bring them back."""
        gone = keys.select(*self.keys).distinct()
        for c in self.columns:
            gone = gone.withColumn(c, F.lit(None).cast(self._types[c]))
        self._note("delete", batch_id)
        self._write(gone.withColumn("__gone", F.lit(True)), batch_id)

    def _in_batch(self, column: str, order: str | None):
        rule = self.rules[column]
        if rule != REPLACE:
            return _MERGE[rule](column).alias(column)
        if order:
            return F.max_by(column, order).alias(column)
        return F.last(column).alias(column)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        typed = [F.col(c).cast(self._types[c]).alias(c) for c in [*self.keys, *self.columns]]
        (rows.select(*typed, "__gone").write.mode("overwrite")
         .parquet(f"{self.root}/changes/batch_id={batch_id}"))

    # -- reading ---------------------------------------------------------------------------------

    def read(self, before: int | None = None) -> DataFrame:
        """One row per key; ``before`` leaves out that batch and later ones."""
        base_upto, last_delete = self._marks(before)
        changes = self.spark.read.parquet(f"{self.root}/changes")
        changes = changes.where(F.col("batch_id") > base_upto)
        if before is not None:
            changes = changes.where(F.col("batch_id") < before)
        rows = changes.where("NOT __gone").select(*self.keys, *self.columns, "batch_id")
        if base_upto >= 0:
            base = self.spark.read.parquet(f"{self.root}/base/upto={base_upto}")
            rows = rows.unionByName(base.select(
                *self.keys, *self.columns, F.lit(base_upto).alias("batch_id")))
        alive = self._not_deleted(rows, changes) if last_delete > base_upto else rows
        return alive.groupBy(*self.keys).agg(*[
            (F.max_by(c, "batch_id") if rule == REPLACE else _MERGE[rule](c))
            .cast(self._types[c]).alias(c) for c, rule in self.rules.items()])

    def _not_deleted(self, rows: DataFrame, changes: DataFrame) -> DataFrame:
        gone = (changes.where("__gone").groupBy(*[F.col(k).alias(f"__g_{k}") for k in self.keys])
                .agg(F.max("batch_id").alias("__gone_at")))
        same = reduce(lambda a, b: a & b,
                      [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in self.keys])
        return rows.join(gone, same & (F.col("batch_id") <= F.col("__gone_at")), "left_anti")

    def get(self, keys: DataFrame, columns: Sequence[str] | None = None,
            defaults: Mapping[str, object] | None = None) -> DataFrame:
        """Stored values for the given keys; a missing key gives nulls or ``defaults``."""
        columns, defaults = list(columns or self.columns), dict(defaults or {})
        found = keys.join(self.read().select(*self.keys, *columns), self.keys, "left")
        return found.fillna(defaults) if defaults else found

    # -- upkeep ----------------------------------------------------------------------------------

    def compact(self, upto: int) -> None:
        """Merge all batches up to and with ``upto`` into a new base."""
        self.read(before=upto + 1).write.mode("overwrite").parquet(f"{self.root}/base/upto={upto}")
        self._note("base", upto)

    def _note(self, event: str, batch_id: int, mode: str = "append") -> None:
        mark = self.spark.range(1, numPartitions=1).select(
            F.lit(event).alias("event"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        mark.write.mode(mode).parquet(f"{self.root}/log")

    def _marks(self, before: int | None) -> tuple[int, int]:
        """The newest base and delete that a reader has to know of."""
        log = self.spark.read.parquet(f"{self.root}/log")
        if before is not None:
            log = log.where(F.col("batch_id") < before)
        marks = log.agg(*[F.max(F.when(F.col("event") == e, F.col("batch_id")))
                          for e in ("base", "delete")]).first()
        return tuple(-1 if m is None else m for m in marks)


def upsert_batches(table: KeyedTable, order: str | None = None, compact_every: int = 50):
    """For ``foreachBatch``: merge each micro-batch into the table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, order)
        if batch_id and batch_id % compact_every == 0:
            table.compact(batch_id)
    return write
