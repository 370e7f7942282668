"""Table functions, and streams with state, sources and sinks of the user: broken midway and restarted."""

import datetime as dt
import json
import os
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from sparkloom.files import read_bytes
from sparkloom.operators.reduce import Reduce, aggregate_by_key
from sparkloom.operators.table_functions import register_table_functions
from sparkloom.plans.state_queries import Spread
from sparkloom.sinks.batches import read_batches, write_once
from sparkloom.sinks.keyed import REPLACE, KeyedTable, upsert_batches
from sparkloom.sinks.transactions import (CommittedFiles, StagedWriter, Written, manifests,
                                          read_committed, sweep)
from sparkloom.sources.literals import elements
from sparkloom.sources.splits import SplitReader, advance, read_splits, write_splits
from sparkloom.streaming import stateful
from sparkloom.streaming.accumulate import ClockSession, accumulate_windows
from sparkloom.streaming.chained import daily_top
from sparkloom.streaming.closing import closed
from sparkloom.streaming.count_windows import stream_count_windows
from sparkloom.streaming.counters import StreamCounters, counted
from sparkloom.streaming.retractions import retracting_summary
from sparkloom.streaming.runtime import rounds, run_with_restart, to_batches, to_files
from sparkloom.streaming.saved_state import saved_operators, saved_state
from sparkloom.streaming.versions import as_of_versions, version_feed
from tests.conftest import rows
from tests.test_streaming import pieces

ADD = Reduce("v", lambda a, b: a + b)


class Breaks:
    """Delivers micro-batches, but fails after half of one of them, once for each id."""

    def __init__(self, deliver, *ids):
        self.deliver, self.ids = deliver, set(ids)

    def __call__(self, batch, batch_id):
        if batch_id in self.ids:
            self.ids.remove(batch_id)
            self.deliver(batch.limit(1), batch_id)
            raise RuntimeError("injected")
        self.deliver(batch, batch_id)


def broken(spark, df, folder, *ids):
    """All rows of a stream in append mode whose run fails in the micro-batches ``ids``."""
    out, ckpt = folder("out"), folder("ckpt")
    deliver = Breaks(write_once(out), *ids)
    assert run_with_restart(lambda: to_batches(df, deliver, ckpt), attempts=len(ids), delay=0) == len(ids)
    return read_batches(spark, out).drop("batch_id")


# --- table functions -------------------------------------------------------------------------------

def test_split_text(spark):
    register_table_functions(spark)
    elements(spark, [(1, "a bug c"), (2, None), (3, "")], "id INT, text STRING").createOrReplaceTempView("lines")
    sql = "SELECT id, s.* FROM lines, LATERAL split_text(text, {}, {}) s"
    assert rows(spark.sql(sql.format("' '", "'bug'"))) == [(1, "a", 0), (1, "c", 2), (3, "", 0)]
    assert rows(spark.sql(sql.format("' '", "CAST(NULL AS STRING)"))) == [
        (1, "a", 0), (1, "bug", 1), (1, "c", 2), (3, "", 0)]
    chars = spark.sql(sql.format("''", "' '"))
    assert chars.columns == ["id", "part"] and chars.count() == 5
    for wrong in ("LATERAL split_text(id, ' ', 'x') s", "LATERAL split_text(text, text, 'x') s"):
        with pytest.raises(AnalysisException):
            spark.sql(f"SELECT * FROM lines, {wrong}").collect()


def test_gaps(spark):
    register_table_functions(spark)
    t0 = dt.datetime(2021, 1, 1)
    elements(spark, [("a", t0, 1), ("a", t0 + dt.timedelta(seconds=2), None), ("b", t0, 5),
                     ("a", t0 + dt.timedelta(days=1), 4), (None, t0, 1)],
             "k STRING, at TIMESTAMP, v INT").createOrReplaceTempView("steps")
    got = spark.sql("SELECT * FROM gaps(TABLE(steps), 'k', 'at', 'v')")
    assert rows(got, "k", "gap_micros", "change") == sorted([
        ("a", None, None), ("a", 2_000_000, None), ("a", 86_398_000_000, None), ("b", None, None),
        (None, None, None)], key=repr)
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM gaps(TABLE(steps), 'k', 'k', 'v')")


# --- accumulators ----------------------------------------------------------------------------------

def test_windows_of_accumulators_after_a_failure(spark, folder):
    batches = [[("a", 1, 1), ("a", 2, 2), ("b", 7, 3)], [("a", 3, 4), ("b", 1, 11), (None, 5, 3)],
               [("a", 100, 1), ("a", 4, 21)], [("a", 0, 90)]]
    stream, _ = pieces(spark, folder, batches)
    marked = stream.withWatermark("ts", "3 seconds")
    out = accumulate_windows(marked, "ts", "10 seconds", ["u"], ["v"], ADD, "v BIGINT")
    got = broken(spark, out, folder, 1, 2)
    start = F.unix_seconds("window_start") - 1609459200
    # ("a", 100, 1) comes when the watermark is past 8 s and its window still open
    assert rows(got.select("u", start.alias("s"), "v")) == sorted(
        [("a", 0, 106), ("b", 0, 7), ("b", 10, 1), (None, 0, 5), ("a", 20, 4)], key=repr)


def test_late_rows_do_not_open_a_closed_window(spark, folder):
    stream, _ = pieces(spark, folder, [[("a", 1, 1)], [("a", 1, 50)], [("a", 9, 2)], [("a", 1, 99)]])
    out = accumulate_windows(stream.withWatermark("ts", "3 seconds"), "ts", "10 seconds", ["u"], ["v"],
                             ADD, "v BIGINT")
    assert rows(broken(spark, out, folder, 0).select("v")) == [(1,), (1,)]


def test_spread_equals_the_batch_aggregate(spark, folder):
    rng = random.Random(3)
    batches = [[(rng.choice("abc"), rng.randint(0, 99), rng.randint(0, 500)) for _ in range(60)] for _ in range(4)]
    stream, given = pieces(spark, folder, batches)
    schema = "n BIGINT, lowest BIGINT, highest BIGINT, total BIGINT"
    given = given.withColumnRenamed("v", "c")
    want = aggregate_by_key(given, ["u"], ["c"], Spread(), schema)
    out = closed(spark, stream.withColumnRenamed("v", "c"), "ts", lambda marked: accumulate_windows(
        marked, "ts", "1 day", ["u"], ["c"], Spread(), schema), "1 hour", "spread")
    assert rows(out.drop("window_start", "window_end")) == rows(want)


class Store:
    """Stands in for a value state and the timers of one key."""

    def __init__(self):
        self.held, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    exists = lambda self: self.held is not None
    get = lambda self: self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def test_clock_session_by_a_manual_clock():
    import pickle
    store, session = Store(), ClockSession(ADD, ["k", "begun", "ends", "v"], 10)
    session.init(store)
    out = []

    def at(now, *values):
        clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
        if values:
            out.extend(session.handleInputRows(("k",), iter([{"__acc": pickle.dumps(v)} for v in values]), clock))
        for timer in sorted(t for t in store.timers if t <= now):
            store.deleteTimer(timer)
            out.extend(session.handleExpiredTimer(
                ("k",), clock, SimpleNamespace(getExpiryTimeInMs=lambda t=timer: t)))

    at(100, 1, 2)
    at(105, 4)                    # prolongs: ends at 115 now
    at(112)
    assert not out and store.timers == {115}
    at(115)
    assert [tuple(r) for r in out] == [("k", 100, 115, 7)] and store.held is None and not store.timers
    at(120, 1)
    at(131, 8)                    # the clock is past the end before the timer came
    at(141)
    assert [tuple(r) for r in out[1:]] == [("k", 120, 130, 1), ("k", 131, 141, 8)]


# --- versions and chained aggregates ---------------------------------------------------------------

def test_versions_by_record_time(spark, folder):
    feed = "k STRING, at INT, name STRING"
    events, _ = pieces(spark, folder, [[("a", 1, 5), ("b", 2, 5)], [("a", 3, 12), ("a", 4, 9)],
                                       [("a", 5, 20), (None, 6, 20)], [("a", 7, 300)]])
    path = folder("versions")
    for batch in ([("a", 0, "a0"), ("a", 10, "a10")], [("b", 6, "b6")], [("a", 18, "a18"), ("a", 9, "a9")]):
        elements(spark, batch, feed).withColumn("from", F.timestamp_seconds(1609459200 + F.col("at"))) \
            .coalesce(1).write.mode("append").parquet(path)
    given = spark.read.parquet(path)
    versions = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(path)
    made = version_feed(events.select("u", "v", "ts"), versions, {"u": "k"}, "ts", "from", ["name"], spread=3)
    out = as_of_versions(made.withWatermark("__time", "60 seconds"))
    got = broken(spark, out, folder, 1, 2)
    # b's event lies before its first version; the event at 300 still waits for the watermark
    assert rows(got, "u", "v", "name") == [("a", 1, "a0"), ("a", 3, "a10"), ("a", 4, "a9"), ("a", 5, "a18")]


def test_chained_aggregates_after_a_failure(spark, folder):
    day = 86_400
    batches = [[("x", 5, 10), ("y", 9, 3700), ("z", 2, 7300), ("w", 1, 7300)], [("x", 6, 9000), ("y", 2, 20)],
               [("x", 1, day + 5), ("y", 1, day + 4000)], [("x", 0, 4 * day)], [("x", 0, 9 * day)]]
    stream, _ = pieces(spark, folder, batches)
    out = daily_top(stream.withWatermark("ts", "2 hours"), "ts", "u", "v", most=2)
    got = broken(spark, out, folder, 1, 3).orderBy("window_start").collect()
    assert [(r.total, r.top_names, r.top_totals) for r in got][:2] == [
        (25, ["x", "y"], [11, 11]), (2, ["x", "y"], [1, 1])]
    assert [r.total for r in got][2:] in ([], [0])


# --- count windows and changelogs ------------------------------------------------------------------

def test_count_windows_over_micro_batches(spark, folder):
    order = iter(range(1000))
    batches = [[("a", next(order), 0) for _ in range(n)] + [("b", next(order), 0)] for n in (3, 1, 7, 2)]
    stream, given = pieces(spark, folder, batches)
    measures = {"n": ("count", None), "last": ("max", "v"), "total": ("sum", "v")}
    got = broken(spark, stream_count_windows(stream, ["u"], "v", 5, measures, slide=2), folder, 1, 3)
    want = []
    for key in "ab":
        seen = sorted(r.v for r in given.where(F.col("u") == key).collect())
        for k in range(2, len(seen) + 1, 2):
            ring = seen[max(0, k - 5):k]
            want.append((key, k // 2, len(ring), max(ring), sum(ring)))
    assert rows(got) == sorted(want, key=repr)


def test_summary_of_a_changelog(spark, folder):
    rng = random.Random(5)
    held, batches = [], []
    for _ in range(6):
        batch = []
        for _ in range(40):
            if held and rng.random() < 0.5:
                key, value = held.pop(rng.randrange(len(held)))
                batch.append((key, value, 0))
            else:
                held.append((rng.choice("abc"), rng.randint(0, 9)))
                batch.append((*held[-1], 1))
        rng.shuffle(batch)
        batches.append(batch)
    batches.append([(*h, 0) for h in held if h[0] == "c"])       # all of c is withdrawn
    held = [h for h in held if h[0] != "c"]
    stream, _ = pieces(spark, folder, batches)
    summary = retracting_summary(stream.withColumn("add", F.col("s") == 1), ["u"], "v", "add")
    table = KeyedTable(spark, folder("t"), "u STRING", "n BIGINT, total BIGINT, lowest BIGINT, highest BIGINT",
                       {c: REPLACE for c in ("n", "total", "lowest", "highest")})
    ckpt, deliver = folder("ckpt"), Breaks(upsert_batches(table), 2, 4)
    assert run_with_restart(lambda: to_batches(summary, deliver, ckpt), attempts=3, delay=0) == 2
    want = []
    for key in "ab":
        values = [v for k, v in held if k == key]
        want.append((key, len(values), sum(values), min(values), max(values)))
    assert rows(table.read().select("u", "n", "total", "lowest", "highest")) == sorted(
        [*want, ("c", 0, 0, None, None)], key=repr)


# --- sink with commit and abort --------------------------------------------------------------------

def failing_once(marker):
    """Fails in the task that has the row 13, unless the marker is there."""
    def check(frames):
        for frame in frames:
            if (frame.v == 13).any() and not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("injected")
            yield frame
    return check


def test_failing_task_leaves_each_row_once(spark, folder):
    spark.dataSource.register(CommittedFiles)
    batches = [[("a", k, 0) for k in range(10)], [("b", k, 0) for k in range(10, 20)], [("c", 20, 0)]]
    stream, given = pieces(spark, folder, batches)
    out, ckpt, marker = folder("out"), folder("ckpt"), folder("marker")
    checked = stream.repartition(4).mapInPandas(failing_once(marker), stream.schema)

    def start():
        return (checked.writeStream.format("committed_files").option("path", out).outputMode("append")
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())

    assert run_with_restart(start, attempts=2, delay=0) == 1
    got = read_committed(spark, out, stream.schema)
    assert rows(got, "v") == rows(given, "v") == sorted([(k,) for k in range(21)], key=repr)
    assert manifests(spark, out).select("batch_id").distinct().count() == 3
    sweep(spark, out, older_than=-60)
    assert len(os.listdir(f"{out}/data")) == manifests(spark, out).count()


def test_commit_and_abort(spark, folder):
    out = folder("out")
    writer = StagedWriter(out)
    batch = pa.RecordBatch.from_pydict({"v": [1, 2]})
    first, again, lost = (writer.write(iter([batch])) for _ in range(3))
    assert writer.write(iter([])) == Written(None)
    assert manifests_of(out) == [] and len(os.listdir(f"{out}/data")) == 3       # written, not published
    writer.commit([first, None, Written(None)], 0)
    writer.commit([again], 0)                                                # the same micro-batch again
    writer.abort([lost, None], 1)
    writer.abort([lost], 1)
    assert manifests_of(out) == [first.file] == os.listdir(f"{out}/data")
    assert rows(read_committed(spark, out, spark.range(0).withColumnRenamed("id", "v").schema)) == [(1,), (2,)]
    broken_rows = iter([batch, None])
    with pytest.raises(AttributeError):
        writer.write(broken_rows)
    assert len(os.listdir(f"{out}/data")) == 1


def manifests_of(out):
    folder = f"{out}/committed"
    if not os.path.isdir(folder):
        return []
    return [json.loads(line)["file"] for name in sorted(os.listdir(folder))
            for line in open(f"{folder}/{name}").read().splitlines()]


# --- split offsets ---------------------------------------------------------------------------------

def test_split_offsets_survive_a_change_of_tasks(spark, folder):
    log, cursor, out, ckpt = folder("log"), f"{folder('cursor')}/c.json", folder("out"), folder("ckpt")
    numbers = spark.range(1000).withColumn("w", F.col("id") % 7)
    write_splits(numbers, log, 5, F.col("w"), "id")
    sizes, deliver = [], Breaks(write_once(out), 1, 3)

    def run(k):
        tasks = (2, 3, 1, 8)[k % 4]
        if k == 4:                                               # the log grows while the query stands
            write_splits(spark.range(1000, 1200).withColumn("w", F.col("id") % 7), log, 7, F.col("w"), "id")
        stream = read_splits(spark, log, numbers.schema, cursor, tasks, 150)
        try:
            query = to_batches(stream, deliver, ckpt)
            query.awaitTermination()
        except StreamingQueryException:
            query = to_batches(stream, deliver, ckpt)            # goes on with the micro-batch that failed
        sizes.append(lambda: [p["numInputRows"] for p in query.recentProgress])
        return query

    assert rounds(run) > 8
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(1200))
    assert max(n for size in sizes for n in size()) <= 300       # a failed micro-batch and the next one
    offsets = json.loads(read_bytes(cursor))
    assert len(offsets) >= 5 and sum(offsets.values()) == 1200


def test_advance_is_bounded_and_even():
    assert advance({}, {"a": 10, "b": 10}, 6) == {"a": 3, "b": 3}
    assert advance({"a": 9}, {"a": 10, "b": 10}, 6) == {"a": 10, "b": 5}
    assert advance({"a": 10}, {"a": 10, "c": 1}, 100) == {"a": 10, "c": 1}
    assert advance({}, {}, 5) == {} and advance({}, {"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}


def test_splits_are_dealt_over_tasks(folder):
    reader = SplitReader({"path": folder(), "cursor": f"{folder('c')}/x", "tasks": "2"}, SimpleNamespace(names=["v"]))
    parts = reader.partitions({"0": 1}, {"0": 4, "1": 2, "2": 0, "3": 5})
    assert [p.spans for p in parts] == [[("0", 1, 4), ("3", 0, 5)], [("1", 0, 2)]]
    assert json.loads(read_bytes(reader.cursor)) == {"0": 4, "1": 2, "2": 0, "3": 5}


# --- counters and saved state ----------------------------------------------------------------------

def test_counters_count_replays_once(spark, folder):
    stream, given = pieces(spark, folder, [[("a", k, 0) for k in range(n)] for n in (3, 5, 2, 4)])
    path, ckpt, out = f"{folder('counters')}/c.json", folder("ckpt"), folder("out")
    deliver = Breaks(write_once(out), 1, 2)
    totals = None
    for _ in range(3):                                           # a new listener each time, as after a crash
        counters = StreamCounters("seen", path)
        spark.streams.addListener(counters)
        seen = counted(stream, "seen", rows=F.count(F.lit(1)), total=F.sum("v"))
        query = to_batches(seen, deliver, ckpt)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            pass
        totals = counters.totals(query.runId)
        spark.streams.removeListener(counters)
    assert totals == {"rows": given.count(), "total": given.agg(F.sum("v")).head()[0]}


def test_a_replayed_micro_batch_replaces_its_figures(folder):
    counters = StreamCounters("n", f"{folder()}/c.json")
    for batch, n in ((0, 3), (1, 9), (1, 5), (0, 100), (2, 1)):
        counters._take(batch, {"rows": n})
    assert counters._sum() == {"rows": 9} == StreamCounters("n", counters.path)._sum()


def test_state_is_read_and_carried_on(spark, folder):
    stream, given = pieces(spark, folder, [[("a", 5, 1), ("b", 2, 2)], [("a", 3, 3), ("b", 9, 4)], [("c", 1, 5)]])
    ckpt = folder("ckpt")
    first = stateful.running_max(stream.select("u", "v", "s"), ["u"], "s", "v")
    to_files(first, folder("out"), ckpt).awaitTermination()
    assert rows(saved_state(spark, ckpt, "value")) == [("a", 5), ("b", 9), ("c", 1)]
    assert rows(saved_state(spark, ckpt, "value", batch=0)) == [("a", 5), ("b", 2)]
    assert saved_operators(spark, ckpt).count() > 0
    later, _ = pieces(spark, folder, [[("a", 1, 6), ("d", 4, 7)], [("a", 7, 8), ("b", 0, 9)]])
    second = stateful.running_max(later.select("u", "v", "s"), ["u"], "s", "v", start=saved_state(spark, ckpt, "value"))
    got = broken(spark, second, folder, 1)
    assert rows(got, "u", "v", "running_max") == [("a", 1, 5), ("a", 7, 7), ("b", 0, 9), ("d", 4, 4)]
