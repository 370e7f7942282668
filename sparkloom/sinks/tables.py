"""Catalog tables as sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def create_table(df: DataFrame, name: str, location: str) -> None:
    """Declare an empty parquet table with the columns of ``df``."""
    columns = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                        f"LOCATION '{location}'")


def insert_into(df: DataFrame, name: str, parts: int | None = None) -> None:
    """INSERT INTO; ``parts`` spreads the rows round robin over that many files."""
    (df.repartition(parts) if parts else df).write.insertInto(name)


def stream_into(df: DataFrame, name: str, checkpoint: str):
    """Continuous INSERT INTO: a started query."""
    return (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .toTable(name))
