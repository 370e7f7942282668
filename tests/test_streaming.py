"""Streams replayed in several micro-batches against their batch twins, and failures on the way."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from sparkloom.operators.joins import interval_join, window_join
from sparkloom.operators.running import running
from sparkloom.operators.windows import arrival_totals, session_totals, window_totals
from sparkloom.plans.catalogue import QUERIES
from sparkloom.plans.word_count import word_count
from sparkloom.sinks.batches import read_batches, write_once
from sparkloom.sinks.keyed import ADD, REPLACE, KeyedTable, upsert_batches
from sparkloom.sources.counter import CounterSource
from sparkloom.sources.generators import festival_sales, orders, ticks
from sparkloom.sources.literals import elements
from sparkloom.streaming import stateful
from sparkloom.streaming.enrich import enrich_to
from sparkloom.streaming.runtime import (live, replay, run_with_failure_rate, run_with_restart,
                                         to_batches, to_files)
from sparkloom.streaming.traced import traced_batches
from sparkloom.streaming.watermark import arrival_time, event_time, progress, with_lateness
from tests.conftest import SMALL, rows

SECOND = dt.timedelta(seconds=1)
START = dt.datetime(2021, 1, 1)


def pieces(spark, folder, batches, schema="u STRING, v INT, s INT"):
    """Batches of literal rows as a stream, one per micro-batch; ``s`` seconds become ``ts``."""
    path = folder("in")
    for batch in batches:
        elements(spark, batch, schema).withColumn(
            "ts", F.timestamp_seconds(F.lit(1609459200) + F.col("s"))).coalesce(1) \
            .write.mode("append").parquet(path)
    given = spark.read.parquet(path)
    return (spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(path),
            given)


def appended(spark, df, folder):
    out = folder("out")
    to_files(df, out, folder("ckpt")).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def changed(spark, df, folder, mode="update"):
    out = folder("out")
    to_batches(df, write_once(out), folder("ckpt"), mode).awaitTermination()
    return read_batches(spark, out)


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def replayed(spark, events, tmp_path_factory):
    """The event table in four micro-batches."""
    path = str(tmp_path_factory.mktemp("replay") / "events")
    return replay(events, path, [250, 500, 800], "event_id")


PROBE = [[("a", 1, 1), ("a", 2, 4)], [("a", 5, 12)], [("a", 7, 2), ("b", 1, 30)], [("b", 9, 90)]]


def test_windows_and_sessions_append(spark, folder):
    stream, _ = pieces(spark, folder, PROBE)
    sums = window_totals(event_time(stream, "ts", "3 seconds"), "ts", "5 seconds", ["u"],
                         [F.sum("v").alias("v")])
    got = {(r.u, (r.window_start - START) // SECOND, r.v) for r in
           appended(spark, sums, folder).collect()}
    assert got == {("a", 0, 10), ("a", 10, 5), ("b", 30, 1)}
    stream, _ = pieces(spark, folder, PROBE)
    sessions = session_totals(event_time(stream, "ts", "3 seconds"), "ts", "10 seconds", ["u"],
                              {"v": ("sum", "v")})
    got = {(r.u, (r.session_start - START) // SECOND, (r.session_end - START) // SECOND, r.v)
           for r in appended(spark, sessions, folder).collect()}
    assert got == {("a", 1, 22, 15), ("b", 30, 40, 1)}


def test_allowed_lateness_updates_a_fired_window(spark, folder):
    stream, _ = pieces(spark, folder, [[("a", 1, 1)], [("a", 1, 9)], [("a", 5, 2)], [("a", 1, 60)],
                                       [("a", 1, 61)], [("a", 100, 3)]])
    sums = window_totals(with_lateness(stream, "ts", "3 seconds", "3 seconds"), "ts", "5 seconds",
                         ["u"], [F.sum("v").alias("v")])
    first = (changed(spark, sums, folder).where(F.col("window_start") == F.lit(START))
             .orderBy("batch_id").collect())
    assert [r.v for r in first] == [1, 6]


def test_late_rows_are_kept_aside(spark, folder):
    stream, given = pieces(spark, folder, [[("a", 1, 10)], [("a", 2, 30)], [("a", 3, 1)],
                                           [("b", 4, 2)], [("a", 5, 40)]])
    tagged = stateful.tag_late(event_time(stream, "ts", "3 seconds"), "ts", "5 seconds")
    out = folder("out")
    # A query on processing time has a next batch at any time, so it is stopped, not awaited.
    query = (tagged.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", folder("c")).trigger(processingTime="1 second").start())
    try:
        for _ in range(60):
            time.sleep(1)
            if len([p for p in query.recentProgress if p["numInputRows"]]) == 5:
                break
    finally:
        query.stop()
    got = spark.read.parquet(out)
    assert rows(got.drop("is_late")) == rows(given)
    assert rows(got.where("is_late"), "v") == [(3,), (4,)]


def test_state_across_batches_equals_batch(spark, replayed, events, folder):
    per_user = dict(keys=["user_id"], order=["event_id"])
    got = appended(spark, stateful.running_max(
        replayed.select("event_id", "user_id", "value"), ["user_id"], "event_id", "value"), folder)
    plain = running(events.select("event_id", "user_id", "value"),
                    measures={"running_max": ("max", "value")}, **per_user)
    assert rows(got) == rows(plain)

    cents = F.round(F.col("value") * 100).cast("long").alias("c")
    measures = {"s": ("sum", "c"), "n": ("count", None), "hi": ("max", "c"), "lo": ("min", "c")}
    for inclusive in (True, False):
        root = folder("trace")
        got = traced_batches(
            replayed.select("event_id", "user_id", cents), root,
            lambda df, deliver: to_batches(df, deliver, folder("ckpt")).awaitTermination(),
            measures=measures, rows=10, compact_every=2, inclusive=inclusive, **per_user)
        plain = running(events.select("event_id", "user_id", cents), measures=measures,
                        inclusive=inclusive, **per_user)
        assert rows(got) == rows(plain)


def test_newness_policies(spark, folder):
    hour = 3600
    visits = [[("u", 1, 0)], [("u", 2, 2 * hour)], [("u", 3, hour)], [("u", 4, 2 * hour + 5)]]
    for remember, flags in (("last", [1, 1, 0, 1]), ("max", [1, 1, 0, 0])):
        stream, _ = pieces(spark, folder, visits)
        got = appended(spark, stateful.newness(stream, ["u"], "ts", "v", remember), folder)
        assert [r.is_hour_new for r in got.orderBy("v").collect()] == flags
        assert [r.is_new for r in got.orderBy("v").collect()] == [1, 0, 0, 0]


def test_changelog_across_batches(spark, folder):
    path = folder("in")
    for batch in ([(1, "hello", 1), (2, "world", 1)], [(3, "hello", 1)]):
        elements(spark, batch, "seq INT, word STRING, n BIGINT").coalesce(1).write.mode(
            "append").parquet(path)
    stream = spark.readStream.schema("seq INT, word STRING, n BIGINT").option(
        "maxFilesPerTrigger", 1).parquet(path)
    got = appended(spark, stateful.changelog(stream, ["word"], "seq", "n"), folder)
    assert [(r.is_add, r.word, r.total) for r in got.orderBy("seq", "step").collect()] == [
        (True, "hello", 1), (True, "world", 1), (False, "hello", 1), (True, "hello", 2)]


def test_review_timers_on_event_time(spark, folder):
    schema = "user_id STRING, order_id STRING, kind STRING, s INT"
    stream, _ = pieces(spark, folder, [
        [("u", "o1", "order", 0), ("u", "o2", "order", 1)], [("u", "o2", "review", 3)],
        [("v", "o3", "order", 20)], [("v", "o9", "review", 21)], [("v", "o4", "order", 60)]],
        schema)
    timed = event_time(stream, "ts", "1 second")
    got = appended(spark, stateful.review_timers(timed, "5 seconds"), folder)
    assert rows(got, "order_id", "status") == [("o1", "auto"), ("o2", "reviewed"), ("o3", "auto")]


def test_review_timers_on_the_clock(spark, folder):
    now = spark.sql("SELECT unix_seconds(current_timestamp()) AS s").first().s
    schema = "user_id STRING, order_id STRING, kind STRING, s BIGINT"
    path, out = folder("in"), folder("out")
    elements(spark, [("u", "o1", "order", now), ("u", "o2", "order", now),
                     ("u", "o2", "review", now)], schema).withColumn(
        "ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    query = (stateful.review_timers(stream, "2 seconds", event_time=False).writeStream
             .format("parquet").option("path", out).option("checkpointLocation", folder("ckpt"))
             .trigger(processingTime="1 second").start())
    try:
        for _ in range(60):
            time.sleep(1)
            got = [] if not query.lastProgress else rows(
                spark.read.schema("user_id STRING, order_id STRING, status STRING").parquet(out),
                "order_id", "status") if query.lastProgress["batchId"] > 0 else []
            if len(got) == 2:
                break
    finally:
        query.stop()
    assert got == [("o1", "auto"), ("o2", "reviewed")]


def test_stream_joins(spark, folder):
    left, l_rows = pieces(spark, folder, [[("k", 1, 10)], [("k", 2, 31)], [("j", 3, 60)]])
    right, r_rows = pieces(spark, folder, [[("k", 7, 8), ("k", 8, 11)], [("k", 9, 34)],
                                           [("j", 10, 61)]])
    rename = dict(u="ru", v="rv", s="rs", ts="rts")
    right, r_rows = right.withColumnsRenamed(rename), r_rows.withColumnsRenamed(rename)
    def both(a, b):
        return event_time(a, "ts", "3 seconds"), event_time(b, "rts", "3 seconds")
    pairs = interval_join(*both(left, right), {"u": "ru"}, "ts", "rts", "-2 seconds", "1 second")
    got = rows(appended(spark, pairs.select("v", "rv"), folder))
    assert got == [(1, 7), (1, 8), (3, 10)]
    assert got == rows(interval_join(l_rows, r_rows, {"u": "ru"}, "ts", "rts", "-2 seconds",
                                     "1 second"), "v", "rv")
    windows = window_join(*both(left, right), {"u": "ru"}, "ts", "rts", "5 seconds")
    got = rows(appended(spark, windows.select("v", "rv"), folder))
    assert got == [(1, 8), (2, 9), (3, 10)]
    assert got == rows(window_join(l_rows, r_rows, {"u": "ru"}, "ts", "rts", "5 seconds"), "v", "rv")


@pytest.mark.parametrize("name, want", [("stream_window_join", [(1, 1, 7), (1, 1, 8)]),
                                        ("stream_interval_join", [(1, 1, 7), (1, 1, 8)])])
def test_joins_go_through_their_state_for_rows_only(spark, folder, monkeypatch, name, want):
    root, runs = folder("tables"), []
    def day(n):
        return dt.datetime(2021, 1, 8) + n * dt.timedelta(days=1)
    elements(spark, [(1, 1, day(0)), (1, 2, day(80)), (None, 3, day(0))],
             "l_orderkey LONG, l_linenumber LONG, l_shipdate TIMESTAMP_NTZ").write.parquet(f"{root}/lineitem.parquet")
    elements(spark, [(1, 7, day(1)), (1, 8, day(1)), (None, 9, day(1)), (2, 9, day(0))],
             "o_orderkey LONG, o_custkey LONG, o_orderdate TIMESTAMP_NTZ").write.parquet(f"{root}/orders.parquet")
    def recorded(*args):
        runs.append(to_files(*args))
        return runs[-1]
    monkeypatch.setattr("sparkloom.streaming.runtime.to_files", recorded)
    names = ("spark.sql.streaming.noDataMicroBatches.enabled",
             "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
    before = [spark.conf.get(n, None) for n in names]
    got = QUERIES[name](spark, root)
    assert rows(got, "l_orderkey", "l_linenumber", "o_custkey") == want
    progressed = [p for q in runs for p in q.recentProgress if p["durationMs"].get("addBatch")]
    assert progressed and all(p["numInputRows"] for p in progressed)
    assert [spark.conf.get(n, None) for n in names] == before


def test_enrichment_follows_the_dimension(spark, folder):
    stream, _ = pieces(spark, folder, [[("u1", 1, 0)], [("u1", 2, 1)], [("u1", 3, 2)]])
    snapshots = [None, elements(spark, [("u1", "old")], "id STRING, name STRING"),
                 elements(spark, [("u1", "new")], "id STRING, name STRING")]
    served = iter(snapshots)
    out = folder("out")
    deliver = enrich_to(out, lambda: next(served), {"u": "id"}, ["name"], broadcast_rows=10)
    to_batches(stream, deliver, folder("ckpt")).awaitTermination()
    assert rows(spark.read.parquet(out), "v", "name") == [(2, "old"), (3, "new")]


def test_word_count_survives_failures(spark, folder):
    """A batch fails after it has written half of its result; the restart repeats it."""
    path, out, ckpt = folder("in"), folder("table"), folder("ckpt")
    for line in ("a b a", "b c", "a c c", "bug a"):
        elements(spark, [line], "value STRING").coalesce(1).write.mode("append").text(path)
    table = KeyedTable(spark, out, "word STRING", "n BIGINT", {"n": ADD})
    failed = set()

    def deliver(batch, batch_id):
        counts = word_count(batch)
        if batch_id in (1, 3) and batch_id not in failed:
            failed.add(batch_id)
            table.upsert(counts.limit(1), batch_id)
            raise RuntimeError("injected")
        table.upsert(counts, batch_id)

    def start():
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
        return to_batches(lines, deliver, ckpt)

    assert run_with_restart(start, attempts=3, delay=0) == 2
    assert rows(table.read()) == [("a", 4), ("b", 2), ("bug", 1), ("c", 3)]


def test_restart_limits(spark, folder):
    stream, _ = pieces(spark, folder, [[("a", 1, 1)]])

    def broken(batch, batch_id):
        raise RuntimeError("always")

    def start(ckpt):
        return lambda: to_batches(stream, broken, ckpt)

    with pytest.raises(Exception, match="always"):
        run_with_restart(start(folder("c")), attempts=1, delay=0)
    with pytest.raises(Exception, match="always"):
        run_with_failure_rate(start(folder("c")), failures=2, within=60, delay=0)


def test_counter_source_resumes_from_its_offset(spark, folder):
    spark.dataSource.register(CounterSource)
    out, ckpt = folder("out"), folder("ckpt")
    calls = []

    def deliver(batch, batch_id):
        calls.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if len(calls) == 1:
            raise RuntimeError("injected")

    def start(total):
        source = (spark.readStream.format("counter").option("total", total).option("tasks", 3)
                  .option("since", 0).load())
        return to_batches(source, deliver, ckpt)

    assert run_with_restart(lambda: start(10), attempts=2, delay=0) == 1
    start(25).awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got, "value") == [(i,) for i in range(10)] + [(i,) for i in range(10, 25)] \
        or sorted(r.value for r in got.collect()) == list(range(25))
    assert got.groupBy("task").count().count() == 3


def test_rate_sources_and_arrival_windows(spark, folder):
    made = orders(ticks(spark, per_second=50, tasks=2))
    table = KeyedTable(spark, folder("t"), "user_id INT, window_start TIMESTAMP", "n BIGINT",
                       {"n": REPLACE})
    counted = arrival_totals(made, "5 seconds", ["user_id"], [F.count(F.lit(1)).alias("n")])
    query = live(counted.drop("window_end"), upsert_batches(table), folder("ckpt"))
    try:
        for _ in range(40):
            time.sleep(0.5)
            if query.lastProgress and query.lastProgress["batchId"] >= 2:
                break
    finally:
        query.stop()
    assert table.read().count() > 0
    assert festival_sales(ticks(spark)).isStreaming and arrival_time(made).isStreaming


def test_watermark_is_visible(spark, folder):
    stream, _ = pieces(spark, folder, PROBE)
    sums = window_totals(event_time(stream, "ts", "3 seconds"), "ts", "5 seconds", ["u"],
                         [F.sum("v").alias("v")])
    query = to_files(sums, folder("o"), folder("c"))
    query.awaitTermination()
    marks = [p["watermark"] for p in progress(query) if "watermark" in p]
    assert "2021-01-01T00:00:09.000Z" in marks


def test_complete_mode_can_sort(spark, folder):
    stream, _ = pieces(spark, folder, PROBE)
    best = stream.groupBy("u").agg(F.sum("v").alias("v")).orderBy(F.desc("v")).limit(1)
    got = changed(spark, best, folder, "complete").orderBy(F.desc("batch_id")).first()
    assert (got.u, got.v) == ("a", 15)


def test_whole_replay_has_the_windows_that_are_still_open(spark):
    from sparkloom.plans.catalogue import QUERIES
    from sparkloom.tables import read_table
    events = read_table(spark, SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    n = F.count(F.lit(1)).alias("n")
    hours = window_totals(events, "ts", "1 hour", ["event_type"],
                          [n, F.max("value").alias("max_value"), F.min("value").alias("min_value")])
    want = {
        "stream_tumbling": hours, "stream_tumbling_sql": hours.drop("max_value", "min_value"),
        "stream_sliding": window_totals(events, "ts", "6 hours", ["event_type"], [n], slide="3 hours"),
        "stream_session": session_totals(events, "ts", "6 hours", ["user_id"], {"n": ("count", None)}),
        "stream_channel_heat": events.groupBy(F.col("event_type").alias("channelID")).agg(
            F.count(F.lit(1)).alias("visited"))}
    for name, whole in want.items():
        out = QUERIES[f"{name}_whole"](spark, SMALL)
        columns = sorted(out.columns)
        plain = whole.select([F.col(c).cast(dict(out.dtypes)[c]).alias(c) for c in columns])
        assert sorted(map(repr, out.select(columns).collect())) == sorted(map(repr, plain.collect())), name
