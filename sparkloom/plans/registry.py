"""Named queries, each a DataFrame function with the SQL text that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import prepare
from sparkloom.tables import read_table, stream_table


class Tables:
    """``t.orders`` reads the table ``orders`` of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = prepare(spark), root

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def stream(self, name: str) -> DataFrame:
        return stream_table(self.spark, self.root, name)

    def views(self, *names: str) -> SparkSession:
        for name in names:
            read_table(self.spark, self.root, name).createOrReplaceTempView(name)
        return self.spark


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register under the function's name; without ``sql`` there is no SQL twin."""
    def register(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql:
            SQL[name] = sql.strip()
        return fn
    return register
