"""Kafka input. Needs the Kafka package of Spark at run time."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

# Start positions by name.
STARTS = ("earliest", "latest")


def start_position(start: str | Mapping[str, Mapping[int, int]]) -> str:
    """``earliest``, ``latest`` or ``{topic: {partition: offset}}`` as the source's option.

    A query keeps its position in its own checkpoint and uses this on its first run only. Offsets that a
    consumer group has stored are not visible to Spark: read them with the broker's tools and pass
    them here, else records that the group has not read yet would be skipped.
    """
    if isinstance(start, Mapping):
        return json.dumps({t: {str(p): o for p, o in own.items()} for t, own in start.items()})
    if start not in STARTS:
        raise ValueError(f"start {start!r}: give {' or '.join(STARTS)}, or offsets by partition")
    return start


def source_options(servers: str, topic: str, *, start: str | Mapping = "latest", group: str | None = None,
                   max_per_batch: int | None = None, min_parts: int | None = None,
                   fail_on_loss: bool = True) -> dict[str, str]:
    """New partitions of the topic are found without a setting."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": start_position(start), "failOnDataLoss": str(fail_on_loss).lower()}
    if group:
        options["groupIdPrefix"] = group
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_parts:
        options["minPartitions"] = str(min_parts)
    return options


def kafka_lines(spark: SparkSession, **where) -> DataFrame:
    """Record values as text, in the column ``value``."""
    raw = spark.readStream.format("kafka").options(**source_options(**where)).load()
    return raw.select(F.col("value").cast("string").alias("value"))
