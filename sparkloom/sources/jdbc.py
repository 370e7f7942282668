"""Tables behind JDBC: parallel scans and snapshots that are read again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """Where a table lives. Spark pushes filters and column choice into the database."""

    url: str
    table: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    options: dict = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        known = {"url": self.url, "dbtable": self.table, "driver": self.driver,
                 "user": self.user, "password": self.password, **self.options}
        return {k: str(v) for k, v in known.items() if v is not None}

    def parallel(self, column: str, low, high, parts: int) -> dict[str, str]:
        """Options that cut the scan into ranges of a column, one task each."""
        return {**self.connection(), "partitionColumn": column, "lowerBound": str(low),
                "upperBound": str(high), "numPartitions": str(parts)}


def snapshot(spark: SparkSession, table: JdbcTable, **cut) -> DataFrame:
    """The table now; ``column, low, high, parts`` make the scan parallel."""
    options = table.parallel(**cut) if cut else table.connection()
    return spark.read.format("jdbc").options(**options).load()


def polled(spark: SparkSession, read: Callable[[], DataFrame],
           deliver: Callable[[DataFrame, int], None], checkpoint: str, every: str = "5 seconds"):
    """Read a full snapshot at every tick and hand it on, so that changes show up.

    Starts a streaming query whose rows are only clock ticks.
    """
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (clock.writeStream.foreachBatch(lambda _, batch_id: deliver(read(), batch_id))
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())
