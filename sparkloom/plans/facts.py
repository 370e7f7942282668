"""Order facts: items joined with the goods offered around the same time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sparkloom.functions.numbers import money_product
from sparkloom.operators.joins import interval_join, window_join


def facts_by_window(items: DataFrame, goods: DataFrame, on: Mapping[str, str], item_time: str,
                    goods_time: str, length: str, count: str, price: str) -> DataFrame:
    """Items and goods of the same window; ``total_money`` is count x price."""
    joined = window_join(items, goods, on, item_time, goods_time, length)
    return joined.withColumn("total_money", money_product(count, price))


def facts_by_interval(items: DataFrame, goods: DataFrame, on: Mapping[str, str], item_time: str,
                      goods_time: str, lower: str, upper: str, count: str,
                      price: str) -> DataFrame:
    """Goods offered from ``lower`` to ``upper`` around each item."""
    joined = interval_join(items, goods, on, item_time, goods_time, lower, upper)
    return joined.withColumn("total_money", money_product(count, price))
