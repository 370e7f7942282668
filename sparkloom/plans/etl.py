"""Keep the successful records of a JSON feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkloom.functions.json import row_json

# The feed's columns. Ids may arrive as JSON texts, so they are read as text.
FEED_TEXT_SCHEMA = "user_id STRING, page_id STRING, status STRING"


def parse_feed(lines: DataFrame, col: str = "value") -> DataFrame:
    row = F.from_json(F.col(col), FEED_TEXT_SCHEMA)
    return (lines.select(row.alias("r"))
            .select(F.col("r.user_id").cast("bigint").alias("user_id"),
                    F.col("r.page_id").cast("bigint").alias("page_id"),
                    F.col("r.status").alias("status")))


def successes(feed: DataFrame, status: str = "success") -> DataFrame:
    return feed.where(F.col("status") == status)


def feed_lines(feed: DataFrame) -> DataFrame:
    """Back to JSON lines."""
    return feed.select(row_json(feed, "user_id", "page_id", "status").alias("value"))
