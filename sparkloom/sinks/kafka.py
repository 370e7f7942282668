"""Kafka output: rows as JSON or text values. At least once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkloom.functions.json import row_json


def sink_options(servers: str, topic: str, transaction_timeout_ms: int | None = None) -> dict:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if transaction_timeout_ms:
        options["kafka.transaction.timeout.ms"] = str(transaction_timeout_ms)
    return options


def as_records(df: DataFrame, key: str | None = None, text: str | None = None) -> DataFrame:
    """``value`` is one text column or the row as JSON; without a key, round robin."""
    value = (F.col(text).cast("string") if text else row_json(df)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append"):
    return (as_records(df).writeStream.outputMode(mode).format("kafka")
            .options(**sink_options(servers, topic)).option("checkpointLocation", checkpoint))
