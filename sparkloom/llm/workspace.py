"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import prepare, shared_dir

# Rows of whole texts that a Python worker holds at once; texts may be very long.
BATCH_ROWS = "500"


class Workspace:
    """One run's tables under ``spark.checkpoint.dir``.

    A table that is read several times is written once; a lost executor then costs a read. Tables
    behind the result stay, those that only lead to the next step are dropped when it is written.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, shared_dir(spark, label)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def text_session(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library and small batches for Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return prepare(spark)
