"""JDBC output: batches of inserts from the tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from sparkloom.sources.jdbc import JdbcTable


def write_options(table: JdbcTable, batch_rows: int = 1000,
                  connections: int | None = None) -> dict[str, str]:
    """``connections`` bounds the tasks that write at once. Leave generated ids out of the rows."""
    options = {**table.connection(), "batchsize": str(batch_rows)}
    if connections:
        options["numPartitions"] = str(connections)
    return options


def append(df: DataFrame, table: JdbcTable, **sizes) -> None:
    df.write.format("jdbc").options(**write_options(table, **sizes)).mode("append").save()


def batch_writer(table: JdbcTable, **sizes) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. A batch that runs again is inserted again: at least once."""
    return lambda batch, batch_id: append(batch, table, **sizes)
