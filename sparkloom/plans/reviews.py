"""Automatic favourable review of orders nobody reviewed in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.functions.time import duration_micros, interval


def review_status(orders: DataFrame, reviews: DataFrame, order_key: str, review_key: str,
                  time: str, now: Column, wait: str) -> DataFrame:
    """Orders with ``reviewed``, ``auto`` (waited long enough) or ``pending``.

    Review keys are made unique map-side first, so a much-reviewed order costs one row.
    """
    seen = reviews.select(F.col(review_key).alias("__reviewed")).distinct()
    due = F.col(time) + interval(duration_micros(wait)) <= now
    status = (F.when(F.col("__reviewed").isNotNull(), "reviewed").when(due, "auto")
              .otherwise("pending"))
    return (orders.join(seen, orders[order_key] == seen["__reviewed"], "left")
            .withColumn("status", status).drop("__reviewed"))


def auto_reviews(orders: DataFrame, reviews: DataFrame, order_key: str, review_key: str,
                 time: str, now: Column, wait: str) -> DataFrame:
    """Only the orders that get the automatic review."""
    due = orders.where(F.col(time) + interval(duration_micros(wait)) <= now)
    seen = reviews.select(F.col(review_key).alias("__reviewed"))
    return due.join(seen, due[order_key] == seen["__reviewed"], "left_anti")
