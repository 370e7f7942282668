"""The state that a query has saved: as a table, and as the start of another query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def saved_state(spark: SparkSession, checkpoint: str, variable: str, *, operator: int = 0,
                batch: int | None = None) -> DataFrame:
    """One row per key of a value state: the fields of the key, then those of the value.

    ``batch`` reads the state as of an earlier micro-batch, as far as its snapshots are kept. Key and value
    fields must not share names.
    """
    reader = (spark.read.format("statestore").option("operatorId", operator)
              .option("stateVarName", variable))
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.*", "value.*")


def saved_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What stateful operators the query of a checkpoint has, and for which micro-batches."""
    return spark.read.format("state-metadata").load(checkpoint)
