"""External catalogs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hive_builder(warehouse: str, metastore: str | None = None) -> SparkSession.Builder:
    """Session builder with a Hive metastore; a catalog is chosen before the session starts."""
    builder = SparkSession.builder.config("spark.sql.warehouse.dir", warehouse)
    if metastore:
        builder = builder.config("spark.hadoop.hive.metastore.uris", metastore)
    return builder.enableHiveSupport()


def use(spark: SparkSession, catalog: str | None = None, database: str | None = None) -> None:
    """Make a catalog and database current."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        spark.catalog.setCurrentDatabase(database)
