"""Queries of table functions, and of streams whose state, sources and sinks are the user's own."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.numbers import cents
from sparkloom.operators.reduce import Accumulator, Reduce
from sparkloom.operators.table_functions import register_table_functions
from sparkloom.operators.windows import window_totals
from sparkloom.plans.batch_queries import n_rows
from sparkloom.plans.registry import Tables, query
from sparkloom.session import shared_dir
from sparkloom.sinks.batches import write_once
from sparkloom.sinks.keyed import REPLACE, KeyedTable, upsert_batches
from sparkloom.sinks.transactions import CommittedFiles, read_committed
from sparkloom.sources.splits import read_splits, write_splits
from sparkloom.streaming import stateful
from sparkloom.streaming.accumulate import accumulate_windows, clock_sessions
from sparkloom.streaming.chained import daily_top
from sparkloom.streaming.closing import closed, in_turns
from sparkloom.streaming.count_windows import stream_count_windows
from sparkloom.streaming.counters import StreamCounters, counted, counters_frame, where_count
from sparkloom.streaming.retractions import retracting_summary
from sparkloom.streaming.runtime import finish, live, rounds, to_batches, to_files, until_idle
from sparkloom.streaming.saved_state import saved_state
from sparkloom.streaming.versions import as_of_versions, version_feed
from sparkloom.streaming.watermark import event_time, with_lateness
from sparkloom.tables import instant, wall_clock


# ---- table functions -----------------------------------------------------------------------------

@query("""SELECT doc_id, part, place FROM (
            SELECT doc_id, unnest(string_split(text, ' ')) AS part,
                   CAST(unnest(range(len(string_split(text, ' ')))) AS INT) AS place FROM documents)
          WHERE NOT contains(part, 'qu')""")
def sql_split_filter(t: Tables):
    """One row to many and a filter, by a table function in a lateral join."""
    register_table_functions(t.views("documents"))
    return t.spark.sql("""SELECT doc_id, s.part, s.place
                          FROM documents, LATERAL split_text(text, ' ', 'qu') AS s""")


@query("""SELECT user_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap_micros,
                 value - lag(value) OVER w AS change
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def sql_gaps(t: Tables):
    """A table function over the ordered rows of each key."""
    register_table_functions(t.views("events"))
    return t.spark.sql("SELECT * FROM gaps(TABLE(events), 'user_id', 'ts', 'value')")


# ---- aggregates of the user ----------------------------------------------------------------------

class Spread(Accumulator):
    """Count, lowest and highest of whole numbers, and their sum."""

    def create(self):
        return None

    def add(self, acc, columns):
        c = columns["c"]
        return self.merge(acc, (len(c), int(c.min()), int(c.max()), int(c.sum())))

    def merge(self, a, b):
        if a is None or b is None:
            return a or b
        return a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), a[3] + b[3]

    def result(self, acc):
        return acc


def order_cents(t: Tables):
    return t.stream("orders").select("o_custkey", instant("o_orderdate").alias("ts"),
                                     cents("o_totalprice").alias("c"))


@query("""SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
          FROM orders GROUP BY o_custkey""")
def stream_custom_reduce(t: Tables):
    """The reduce of ``custom_reduce`` as state: sums per quarter of a stream, closed by timers."""
    out = closed(t.spark, order_cents(t), "ts", lambda rows: accumulate_windows(
        rows, "ts", "90 days", ["o_custkey"], ["c"], Reduce("c", lambda a, b: a + b), "c BIGINT"),
        "4000 days", "reduced")
    return out.groupBy("o_custkey").agg(F.sum("c").alias("total_cents"))


@query("""SELECT event_type, s AS window_start, s + INTERVAL 6 HOUR AS window_end, n, lowest, highest, total
          FROM (SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts) AS s, count(*) AS n,
                       min(CAST(round(value * 100) AS BIGINT)) AS lowest,
                       max(CAST(round(value * 100) AS BIGINT)) AS highest,
                       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
                FROM events GROUP BY ALL)""")
def stream_accumulated(t: Tables):
    """A user's accumulator per key and event-time window."""
    rows = t.stream("events").select("event_type", instant("ts").alias("ts"), cents("value").alias("c"))
    out = closed(t.spark, rows, "ts", lambda marked: accumulate_windows(
        marked, "ts", "6 hours", ["event_type"], ["c"], Spread(),
        "n BIGINT, lowest BIGINT, highest BIGINT, total BIGINT"), "1 hour", "accumulated")
    return out.withColumns({c: wall_clock(c) for c in ("window_start", "window_end")})


# ---- versions and chained aggregates -------------------------------------------------------------

VERSIONS_SQL = """SELECT c_custkey, version, c_mktsegment || '-' || version AS segment,
        DATE '1992-06-01'::TIMESTAMP + INTERVAL (c_custkey % 200 + 500 * version) DAY AS valid_from
      FROM customer, (VALUES (0), (1), (2), (3)) AS v(version)"""


@query(f"""WITH versions AS ({VERSIONS_SQL})
           SELECT o_orderkey, o_custkey, version, segment FROM orders ASOF JOIN versions
           ON o_custkey = c_custkey AND o_orderdate >= valid_from""")
def stream_versioned(t: Tables):
    """Orders with the customer's segment as of the order's own date."""
    orders = t.stream("orders").select("o_orderkey", "o_custkey", instant("o_orderdate").alias("ts"))
    version = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("version")
    begin = F.expr("timestamp'1992-06-01 00:00:00' + make_dt_interval(CAST(c_custkey % 200 + 500 * version AS INT))")
    versions = (t.stream("customer").select("c_custkey", "c_mktsegment", version)
                .select("c_custkey", "version", begin.alias("valid_from"),
                        F.concat_ws("-", "c_mktsegment", "version").alias("segment")))
    feed = version_feed(orders, versions, {"o_custkey": "c_custkey"}, "ts", "valid_from",
                        ["version", "segment"], spread=2)
    out = closed(t.spark, feed, "__time", as_of_versions, "4000 days", "versioned")
    return out.drop("ts")


@query("""WITH d AS (
            SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type,
                   CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
            FROM events GROUP BY ALL),
          r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY total DESC, event_type) AS k FROM d)
          SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, CAST(sum(total) AS BIGINT) AS total,
                 list(event_type ORDER BY k) FILTER (k <= 3) AS top_names,
                 list(total ORDER BY k) FILTER (k <= 3) AS top_totals
          FROM r GROUP BY window_start""")
def stream_daily_top(t: Tables):
    """Hourly totals to daily totals to a daily top list, in one stream."""
    rows = t.stream("events").select("event_type", instant("ts").alias("ts"), cents("value").alias("c"))
    out = closed(t.spark, rows, "ts", lambda marked: daily_top(marked, "ts", "event_type", "c"),
                 "1 hour", "daily-top")
    return out.withColumns({c: wall_clock(c) for c in ("window_start", "window_end")})


# ---- late rows and early results -----------------------------------------------------------------

DELAYED_SQL = """
  last AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events WHERE event_id % 7 <> 0),
  seen AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             event_id % 7 = 0 AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR + INTERVAL 30 MINUTE
               <= (SELECT mark FROM last) AS is_late FROM events)"""


def delayed(t: Tables):
    """The events, of which every seventh comes only after all others."""
    late = F.col("event_id") % 7 == 0
    columns = ["event_id", "event_type", instant("ts").alias("ts")]
    return t.stream("events").where(~late).select(*columns), t.events.where(late).select(*columns)


@query(f"""WITH {DELAYED_SQL} SELECT event_type, window_end - INTERVAL 1 HOUR AS window_start, window_end,
             count(*) AS n FROM seen WHERE NOT is_late GROUP BY ALL""")
def stream_late_updates(t: Tables):
    """Windows that have fired take rows up to half an hour late, and are given again."""
    root = shared_dir(t.spark, "late")
    rows, later = delayed(t)
    table = KeyedTable(t.spark, f"{root}/table", "event_type STRING, window_start TIMESTAMP, window_end TIMESTAMP",
                       "n BIGINT", {"n": REPLACE})

    def run(both):
        marked = with_lateness(both, "ts", "10 minutes", "30 minutes")
        counts = window_totals(marked, "ts", "1 hour", ["event_type"], [n_rows()])
        to_batches(counts, upsert_batches(table), f"{root}/checkpoint", "update").awaitTermination()

    in_turns(t.spark, rows, later, run, root)
    return table.read().withColumns({c: wall_clock(c) for c in ("window_start", "window_end")})


@query(f"WITH {DELAYED_SQL} SELECT event_id, is_late FROM seen")
def stream_late_rows(t: Tables):
    """Rows whose window has closed, lateness included, go on with a mark instead of being lost."""
    root = shared_dir(t.spark, "aside")
    rows, later = delayed(t)

    def run(both):
        out = stateful.tag_late(both.withWatermark("ts", "10 minutes"), "ts", "1 hour", "30 minutes")
        until_idle(live(out, write_once(f"{root}/out"), f"{root}/checkpoint", mode="append"))
        return out

    out = in_turns(t.spark, rows, later, run, root)
    return t.spark.read.schema(out.schema).parquet(f"{root}/out").select("event_id", "is_late")


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                 time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS n
          FROM events GROUP BY ALL""")
def stream_early_results(t: Tables):
    """Open windows are told every second; the last word on each is kept."""
    root = shared_dir(t.spark, "early")
    counts = window_totals(event_time(t.stream("events"), "ts", "1 day"), "ts", "1 day", ["event_type"], [n_rows()])
    table = KeyedTable(t.spark, f"{root}/table", "event_type STRING, window_start TIMESTAMP, window_end TIMESTAMP",
                       "n BIGINT", {"n": REPLACE})
    until_idle(live(counts, upsert_batches(table), f"{root}/checkpoint"), keep_state=True)
    return table.read().withColumns({c: wall_clock(c) for c in ("window_start", "window_end")})


# ---- sessions on the clock, count windows, changelogs --------------------------------------------

@query("""SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
          FROM events GROUP BY user_id""")
def stream_clock_sessions(t: Tables):
    """Sessions that the clock ends; where they are cut depends on it, what they add up to does not."""
    root = shared_dir(t.spark, "clock")
    rows = t.stream("events").select("user_id", cents("value").alias("c"))
    sessions = clock_sessions(rows, "2 seconds", ["user_id"], ["c"], Spread(),
                              "n BIGINT, lowest BIGINT, highest BIGINT, total BIGINT")
    until_idle(live(sessions, write_once(f"{root}/out"), f"{root}/checkpoint", mode="append"))
    stored = t.spark.read.schema(sessions.schema).parquet(f"{root}/out")
    return stored.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("""WITH r AS (SELECT user_id, event_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
               f AS (SELECT *, (rn + 3) // 4 + k AS firing FROM r, (VALUES (0), (1), (2)) o(k))
          SELECT user_id, firing, count(*) AS n, max(event_id) AS last_id FROM f
          WHERE rn > firing * 4 - 10 GROUP BY user_id, firing HAVING max(rn) = firing * 4""")
def stream_count_window_sliding(t: Tables):
    """The last ten events of a user after every four."""
    rows = t.stream("events").select("user_id", "event_id")
    out = stream_count_windows(rows, ["user_id"], "event_id", 10, {
        "n": ("count", None), "last_id": ("max", "event_id")}, slide=4)
    return finish(t.spark, out, "ring")


@query("""WITH u AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
                   FROM events GROUP BY user_id)
          SELECT total // 20000 AS bracket, count(*) AS n, CAST(sum(total) AS BIGINT) AS total,
                 min(total) AS lowest, max(total) AS highest FROM u GROUP BY ALL""")
def stream_brackets(t: Tables):
    """Users counted by the bracket of their running total, from the changelog of the totals."""
    root = shared_dir(t.spark, "brackets")
    rows = t.stream("events").select("user_id", "event_id", cents("value").alias("c"))
    changes = stateful.changelog(rows, ["user_id"], "event_id", "c").withColumn(
        "bracket", F.expr("total div 20000"))
    summary = retracting_summary(changes, ["bracket"], "total", "is_add")
    table = KeyedTable(t.spark, f"{root}/table", "bracket BIGINT",
                       "n BIGINT, total BIGINT, lowest BIGINT, highest BIGINT",
                       {c: REPLACE for c in ("n", "total", "lowest", "highest")})
    to_batches(summary, upsert_batches(table), f"{root}/checkpoint").awaitTermination()
    return table.read().where("n > 0")


# ---- sinks, sources, counters and saved state ----------------------------------------------------

@query("""SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'""")
def stream_committed(t: Tables):
    """Rows published by the commit of their micro-batch."""
    root = shared_dir(t.spark, "committed")
    t.spark.dataSource.register(CommittedFiles)
    rows = t.stream("events").where("event_type <> 'error'").select("event_id", "user_id", "event_type", "value")
    (rows.writeStream.format("committed_files").option("path", f"{root}/out").outputMode("append")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return read_committed(t.spark, f"{root}/out", rows.schema)


@query("""SELECT event_id, user_id, ts, value FROM events""")
def stream_split_log(t: Tables):
    """A log of five splits, read by two tasks in the first run and by three in the later ones."""
    root = shared_dir(t.spark, "log")
    events = t.events.select("event_id", "user_id", "ts", "value")
    write_splits(events, f"{root}/log", 5, F.col("user_id"), "event_id")
    third = events.count() // 3 + 1

    def run(k: int):
        rows = read_splits(t.spark, f"{root}/log", events.schema, f"{root}/cursor.json", 2 if k == 0 else 3, third)
        return to_files(rows, f"{root}/out", f"{root}/checkpoint")

    rounds(run)
    return t.spark.read.schema(events.schema).parquet(f"{root}/out")


@query("""SELECT 'cents' AS counter, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS n FROM events
          UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error'
          UNION ALL SELECT 'rows', count(*) FROM events""")
def stream_counters(t: Tables):
    """Counters of a whole job, told by its progress."""
    root = shared_dir(t.spark, "counters")
    counters = StreamCounters("job", f"{root}/counters.json")
    t.spark.streams.addListener(counters)
    try:
        rows = counted(t.stream("events"), "job", rows=F.count(F.lit(1)), cents=F.sum(cents("value")),
                       errors=where_count(F.col("event_type") == "error"))
        query = to_files(rows.select("event_id"), f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
        return counters_frame(t.spark, counters.totals(query.runId))
    finally:
        t.spark.streams.removeListener(counters)


@query("""SELECT event_id, user_id, value, max(value) OVER
            (PARTITION BY user_id ORDER BY event_id) AS running_max FROM events""")
def stream_carried_max(t: Tables):
    """Running maxima of the first half of the events, their state read and carried into a second query."""
    root = shared_dir(t.spark, "carried")
    half = t.events.agg(F.expr("percentile_approx(event_id, 0.5)")).head()[0] or 0
    rows = t.stream("events").select("event_id", "user_id", "value")
    first = stateful.running_max(rows.where(F.col("event_id") <= half), ["user_id"], "event_id", "value")
    to_files(first, f"{root}/first", f"{root}/checkpoint").awaitTermination()
    saved = saved_state(t.spark, f"{root}/checkpoint", "value")
    second = stateful.running_max(rows.where(F.col("event_id") > half), ["user_id"], "event_id", "value", start=saved)
    to_files(second, f"{root}/second", f"{root}/checkpoint-2").awaitTermination()
    return t.spark.read.schema(first.schema).parquet(f"{root}/first", f"{root}/second")
