"""Generated records, as column expressions over numbered ticks.

Every value is a hash of the tick number, so a task that runs again makes the same rows. Ticks
come from the rate source (a stream) or from a range (a batch): both have ``timestamp`` and
``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkloom.functions.numbers import pick
from sparkloom.plans.clicklog import click_message
from sparkloom.plans.festival import CATEGORIES

# Goods on sale as (id, name, price).
GOODS = [("1", "小米12", 4890), ("2", "iphone12", 12000), ("3", "MacBookPro", 15000),
         ("4", "Thinkpad X1", 9800), ("5", "MeiZu One", 3200), ("6", "Mate 40", 6500)]


def ticks(spark: SparkSession, per_second: int = 1, tasks: int = 1) -> DataFrame:
    """Endless ticks; ``tasks`` is the parallelism of the source."""
    return (spark.readStream.format("rate").option("rowsPerSecond", per_second)
            .option("numPartitions", tasks).load())


def batch_ticks(spark: SparkSession, n: int, tasks: int | None = None,
                start: str = "2021-01-01 00:00:00", step_ms: int = 1000) -> DataFrame:
    """``n`` ticks, ``step_ms`` apart."""
    ids = spark.range(0, n, 1, tasks) if tasks else spark.range(n)
    first = F.unix_millis(F.lit(start).cast("timestamp"))
    return ids.select(F.timestamp_millis(first + F.col("id") * step_ms).alias("timestamp"),
                      F.col("id").alias("value"))


def number(salt: str, n: int) -> Column:
    """Hash of the tick in 0 .. n-1."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col("value")), F.lit(n))


def fraction(salt: str) -> Column:
    """Hash of the tick in [0, 1)."""
    return number(salt, 1 << 30) / float(1 << 30)


def record_id() -> Column:
    return F.sha2(F.concat(F.lit("id"), F.col("value").cast("string")), 256).substr(1, 32)


def now_ms() -> Column:
    return F.unix_millis("timestamp")


def orders(t: DataFrame, late_seconds: int = 0) -> DataFrame:
    """Orders of users 0-2 for 0-100; the event time lags by 0 to ``late_seconds``."""
    lag = number("lag", late_seconds + 1) * 1000
    return t.select(record_id().alias("id"), number("user", 3).cast("int").alias("user_id"),
                    number("money", 101).cast("int").alias("money"),
                    (now_ms() - lag).alias("create_time"))


def festival_sales(t: DataFrame) -> DataFrame:
    """Sales of 12 categories, price in [0, 100)."""
    return t.select(pick(CATEGORIES, F.concat(F.lit("cat"), F.col("value").cast("string")))
                    .alias("category"),
                    (fraction("price") * 100).alias("price"), F.col("timestamp").alias("ts"))


def review_orders(t: DataFrame) -> DataFrame:
    """Orders of five users that wait for a review."""
    return t.select(number("user", 5).cast("string").alias("user_id"),
                    record_id().alias("order_id"), F.col("timestamp").alias("ts"))


def user_events(t: DataFrame) -> DataFrame:
    return t.select(F.concat(F.lit("user_"), (number("user", 4) + 1).cast("string"))
                    .alias("user_id"),
                    F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
                    F.concat(F.lit("type_"), number("type", 3).cast("string"))
                    .alias("event_type"),
                    number("product", 4).cast("int").alias("product_id"))


def goods(t: DataFrame) -> DataFrame:
    """The whole price list at every tick."""
    rows = F.array(*[F.struct(F.lit(i).alias("goods_id"), F.lit(n).alias("goods_name"),
                              F.lit(p).cast("decimal(18,2)").alias("goods_price"))
                     for i, n, p in GOODS])
    return t.select(F.col("timestamp").alias("goods_ts"), F.inline(rows))


def order_items(t: DataFrame) -> DataFrame:
    return t.select(record_id().alias("item_id"),
                    (number("goods", len(GOODS)) + 1).cast("string").alias("item_goods_id"),
                    (number("count", 10) + 1).cast("int").alias("count"),
                    F.col("timestamp").alias("item_ts"))


def sensor_lines(t: DataFrame, sensors: int = 4) -> DataFrame:
    """Lines ``sensor,count``."""
    return t.select(F.concat_ws(",", (number("sensor", sensors) + 1).cast("string"),
                                number("cars", 10).cast("string")).alias("value"))


def click_lines(t: DataFrame) -> DataFrame:
    """Nested click messages as JSON lines."""
    return t.select(click_message(F.col("value"), now_ms()).alias("value"))
