"""Operators cut into slices give the same rows as the plain form, with one key holding most rows
and with missing keys."""

import pytest
from pyspark.sql import Window, functions as F

from sparkloom.operators.changelog import changelog
from sparkloom.operators.lateness import tag_lateness, watermark_audit
from sparkloom.operators.newness import newness
from sparkloom.operators.running import SLICE, WHOLE, running, with_slices
from sparkloom.operators.windows import count_windows, session_totals, window_elements
from tests.conftest import rows

SIZES = [7, 50, 10_000_000]


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; key 1 holds two thirds, the missing key many of the rest. Times are uneven."""
    seed = F.xxhash64("id")
    key = (F.when(F.col("id") % 3 != 0, 1).when(F.col("id") % 2 == 0, F.lit(None))
           .otherwise(2 + F.pmod(seed, F.lit(40))).cast("int"))
    seconds = F.floor(F.pow(F.col("id"), 1.3)) + F.pmod(seed, F.lit(30))
    return spark.range(0, 3000, 1, 5).select(
        "id", key.alias("k"), F.timestamp_seconds(seconds).alias("ts"),
        F.when(F.col("id") % 11 != 0, F.pmod(seed, F.lit(1000))).alias("v"))


def test_slices_keep_order_and_bound_size(skewed):
    cut = with_slices(skewed, ["k"], ["id"], 50)
    per_slice = cut.groupBy("k", SLICE).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"),
                                            F.max("id").alias("hi"))
    assert per_slice.agg(F.max("n")).first()[0] <= 50
    ordered = Window.partitionBy("k").orderBy(SLICE)
    assert per_slice.withColumn("before", F.lag("hi").over(ordered)).where("before >= lo").count() == 0


@pytest.mark.parametrize("keys", [["k"], []])
def test_outliers_and_bursts_are_cut(spark, keys):
    """One early row and a thousand at one instant: no slice has more than twice the limit."""
    at = F.when(F.col("id") == 0, 0).when(F.col("id") % 2 == 0, 5_000_000).otherwise(4_000_000 + F.col("id"))
    busy = spark.range(0, 2000, 1, 5).select(F.lit(1).alias("k"), at.alias("t"), "id")
    cut = with_slices(busy, keys, ["t", "id"], 100)
    sizes = [r["count"] for r in cut.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200 and cut.where(F.col(SLICE) == WHOLE).count() == 0
    got = running(busy, keys, ["t", "id"], {"n": ("count", None)}, rows=100)
    assert sorted(r.n for r in got.collect()) == list(range(1, 2001))


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(skewed, size, inclusive):
    got = running(skewed, ["k"], ["ts", "id"], {
        "s": ("sum", "v"), "c": ("count", "v"), "n": ("count", None), "hi": ("max", "v"),
        "lo": ("min", "v"), "last": ("last", "v")}, inclusive=inclusive, rows=size)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    plain = skewed.withColumns({
        "s": F.sum("v").over(w), "c": F.count("v").over(w), "n": F.count(F.lit(1)).over(w),
        "hi": F.max("v").over(w), "lo": F.min("v").over(w), "last": F.last("v", True).over(w)})
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("size", SIZES)
def test_sessions(skewed, size):
    got = session_totals(skewed, "ts", "12 seconds", ["k"],
                         {"n": ("count", None), "s": ("sum", "v"), "hi": ("max", "v")}, rows=size)
    plain = skewed.groupBy("k", F.session_window("ts", "12 seconds").alias("w")).agg(
        F.count(F.lit(1)), F.sum("v"), F.max("v"))
    assert rows(got) == rows(plain.select("k", "w.start", "w.end", *plain.columns[2:]))


@pytest.mark.parametrize("size", SIZES)
def test_no_key(skewed, size):
    got = watermark_audit(skewed, "ts", ["id"], "3 seconds", rows=size)
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("max_time", F.max("ts").over(w)).withColumn(
        "watermark", F.col("max_time") - F.expr("INTERVAL 3.001 SECONDS"))
    assert rows(got) == rows(plain)
    statuses = tag_lateness(skewed, "ts", ["id"], "10 seconds", "3 seconds", "5 seconds",
                            rows=size).groupBy("lateness").count()
    assert rows(statuses) == rows(tag_lateness(
        skewed, "ts", ["id"], "10 seconds", "3 seconds", "5 seconds").groupBy("lateness").count())
    assert statuses.count() == 3


@pytest.mark.parametrize("size", SIZES[:2])
def test_others_do_not_depend_on_slices(skewed, size):
    n = F.count(F.lit(1)).alias("n")
    for make in (
            lambda s: newness(skewed, ["k"], "ts", ["ts", "id"], rows=s),
            lambda s: newness(skewed, ["k"], "ts", ["id"], remember="max", rows=s),
            lambda s: changelog(skewed.fillna(0, ["v"]), ["k"], ["id"], "v", rows=s),
            lambda s: count_windows(skewed, ["k"], ["id"], 10, [n], slide=4, rows=s),
            lambda s: count_windows(skewed, ["k"], ["id"], 3, [n], slide=5, rows=s),
            lambda s: count_windows(skewed, ["k"], ["id"], 10, [n], partial=True, rows=s),
            lambda s: window_elements(skewed, "ts", "1 hour", "k", ["ts", "id"], part_rows=20,
                                      rows=s)):
        assert rows(make(size)) == rows(make(SIZES[-1]))


def test_count_windows_by_hand(spark):
    df = spark.range(1, 11).select(F.lit("a").alias("k"), "id")
    last = F.max("id").alias("last"), F.min("id").alias("first")
    got = rows(count_windows(df, ["k"], ["id"], 4, last, slide=2), "firing", "first", "last")
    assert got == [(1, 1, 2), (2, 1, 4), (3, 3, 6), (4, 5, 8), (5, 7, 10)]
    assert rows(count_windows(df, ["k"], ["id"], 4, last), "firing", "first", "last") == [
        (1, 1, 4), (2, 5, 8)]
    assert rows(count_windows(df, ["k"], ["id"], 2, last, slide=4), "firing", "first", "last") == [
        (1, 3, 4), (2, 7, 8)]


def test_long_windows_are_listed_in_parts(skewed):
    parts = window_elements(skewed, "ts", "1 hour", "k", ["ts", "id"], part_rows=20)
    windows = parts.groupBy("k", "window_start").agg(F.max("n_elements").alias("n"), F.min("n_elements").alias("m"),
                                                     F.count("*").alias("parts"))
    assert windows.where("n != m OR parts != ceil(n / 20)").isEmpty()
    assert windows.agg(F.sum("n")).first()[0] == 3000 and windows.agg(F.max("parts")).first()[0] > 1


@pytest.mark.parametrize("size", SIZES)
def test_missing_order_values_come_first(spark, size):
    df = spark.range(0, 400, 1, 4).select(
        "id", F.lit(1).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("at"),
        (F.col("id") % 7).alias("v"))
    w = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running(df, ["k"], ["at", "id"], {"s": ("sum", "v")}, rows=size)
    assert rows(got) == rows(df.withColumn("s", F.sum("v").over(w)))
    alone = running(df.drop("k"), [], ["at", "id"], {"s": ("sum", "v")}, rows=size)
    assert rows(alone) == rows(df.withColumn("s", F.sum("v").over(w)).drop("k"))
