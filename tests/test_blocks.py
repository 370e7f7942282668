"""State of many keys in one group: as right as a state per key, and few groups for many keys."""

import pytest
from pyspark.sql import functions as F

from sparkloom.streaming import accumulate, stateful
from sparkloom.streaming.accumulate import accumulate_windows
from sparkloom.streaming.runtime import to_batches
from sparkloom.streaming.versions import as_of_versions, version_feed
from tests.conftest import rows
from tests.test_state_queries import ADD, broken
from tests.test_streaming import pieces

KEYS = 3000


def state_rows(df, folder):
    query = to_batches(df, lambda batch, batch_id: batch.count(), folder("ckpt"))
    query.awaitTermination()
    return max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress)


def test_windows_of_many_keys_share_groups(spark, folder):
    batches = [[(f"u{i}", i, 1) for i in range(KEYS)], [(f"u{i}", 1, 2) for i in range(KEYS)], [(None, 0, 99)]]
    stream, _ = pieces(spark, folder, batches)
    out = accumulate_windows(stream.withWatermark("ts", "3 seconds"), "ts", "10 seconds", ["u"], ["v"],
                             ADD, "v BIGINT")
    assert rows(broken(spark, out, folder, 1).select("u", "v")) == rows(
        spark.range(KEYS).select(F.concat(F.lit("u"), F.col("id").cast("string")), F.col("id") + 1))
    assert state_rows(out, folder) < KEYS


@pytest.mark.parametrize("size", [1, 3])
def test_accumulators_are_merged_into_totals(spark, folder, monkeypatch, size):
    monkeypatch.setattr(accumulate, "ROWS", size)
    batches = [[("a", 1, 1), ("b", 2, 1)], [("a", 4, 2), ("c", 8, 2)], [("a", 16, 3)], [(None, 5, 4), ("b", 32, 4)],
               [("a", 64, 1)], [("z", 0, 99)]]
    stream, _ = pieces(spark, folder, batches)
    out = accumulate_windows(stream.withWatermark("ts", "5 seconds"), "ts", "10 seconds", ["u"], ["v"],
                             ADD, "v BIGINT", slots=1)
    assert rows(broken(spark, out, folder, 2), "u", "v") == sorted(
        [("a", 85), ("b", 34), ("c", 8), (None, 5)], key=repr)


def test_versions_of_many_keys_share_groups(spark, folder):
    events, given = pieces(spark, folder, [[(f"u{i}", i, 50) for i in range(KEYS)], [("none", 0, 999)]])
    versions = given.where("v < 9999").selectExpr("u AS k", "timestamp_seconds(1609459200) AS from", "'old' AS name")
    path = folder("versions")
    versions.unionByName(versions.selectExpr("k", "timestamp_seconds(1609459240) AS from", "'new' AS name")) \
        .where("k <> 'none'").coalesce(1).write.parquet(path)
    feed = version_feed(events.select("u", "v", "ts"), spark.readStream.schema(versions.schema).parquet(path),
                        {"u": "k"}, "ts", "from", ["name"])
    out = as_of_versions(feed.withWatermark("__time", "100 seconds"))
    got = broken(spark, out, folder, 0)
    assert rows(got.groupBy("name").count()) == [("new", KEYS)]
    assert state_rows(out, folder) < KEYS


def test_reviews_of_many_orders_share_groups(spark, folder):
    schema = "user_id STRING, order_id STRING, kind STRING, s INT"
    first = [("u", f"o{i}", "order", i % 7) for i in range(KEYS)]
    second = [("u", f"o{i}", "review", i % 7 + (4 if i % 2 else 6)) for i in range(KEYS)]
    stream, _ = pieces(spark, folder, [first, second, [("v", "x", "other", 40)], [("v", "y", "order", 99)]], schema)
    out = stateful.review_timers(stream.withWatermark("ts", "20 seconds"), "5 seconds")
    got = broken(spark, out, folder, 1)
    assert rows(got.groupBy("status").count()) == [("auto", KEYS // 2), ("reviewed", KEYS // 2)]
    assert state_rows(out, folder) < KEYS


@pytest.mark.parametrize("remember, back", [("last", 1), ("max", 0)])
def test_visits_of_many_keys_share_groups(spark, folder, remember, back):
    batches = [[(None, 0, None), *[(f"u{i}", 0, 7200) for i in range(KEYS)]], [(f"u{i}", 1, 3600) for i in range(KEYS)],
               [(f"u{i}", 2, 7201) for i in range(KEYS)]]
    stream, _ = pieces(spark, folder, batches)
    out = stateful.newness(stream, ["u"], "ts", "v", remember)
    got = broken(spark, out, folder, 1)
    assert rows(got.groupBy("v", "is_new", "is_hour_new", "is_day_new").count()) == [
        (0, 1, 1, 1, KEYS + 1), (1, 0, 0, 0, KEYS), (2, 0, back, 0, KEYS)]
    assert state_rows(out, folder) < KEYS
