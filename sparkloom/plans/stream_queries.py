"""Streaming twins: the test tables read as streams, results checked like batch queries.

Append-mode windows are emitted once the watermark has passed them; a last row closes the replay, so
that all of them are. The queries named ``..._whole`` give the same windows by update mode into a keyed
table, without a last row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.numbers import cents, from_cents
from sparkloom.functions.text import pair_text
from sparkloom.operators.joins import interval_join, window_join
from sparkloom.operators.ranking import dashboard, exact_sum
from sparkloom.operators.sets import union_distinct
from sparkloom.operators.windows import (arrival_totals, local_day_offset, session_totals,
                                         window_totals)
from sparkloom.plans import clicklog, etl
from sparkloom.plans.batch_queries import (DASHBOARD_SQL, NEWNESS_SQL, WORDS_SQL, click_lines,
                                           money, n_rows)
from sparkloom.plans.registry import Tables, query
from sparkloom.plans.word_count import word_count as count_words
from sparkloom.session import shared_dir
from sparkloom.sinks.keyed import ADD, REPLACE, KeyedTable, upsert_batches
from sparkloom.sinks.files import with_date
from sparkloom.streaming import stateful
from sparkloom.streaming.closing import closed
from sparkloom.streaming.enrich import enrich_to
from sparkloom.streaming.runtime import INNER_JOIN, finish, to_batches, to_files
from sparkloom.streaming.side_outputs import routed_batches
from sparkloom.streaming.traced import traced_batches
from sparkloom.streaming.watermark import event_time
from sparkloom.tables import instant, wall_clock

def timed(t: Tables, bound: str = "1 hour"):
    return event_time(t.stream("events"), "ts", bound)


def closed_events(t: Tables, plan, label: str, bound: str = "1 hour"):
    """All that ``plan`` emits in append mode, the windows that the events leave open included."""
    return closed(t.spark, t.stream("events").withColumn("ts", instant("ts")), "ts", plan, bound, label)


def plain_times(df, *names: str):
    return df.withColumns({n: wall_clock(n) for n in names})


def run_to(df, deliver, root: str, mode: str = "append"):
    to_batches(df, deliver, f"{root}/checkpoint", mode).awaitTermination()


def run_keyed(t: Tables, df, label: str, keys: str, columns: str):
    """Run in update mode; the last value of every key, whether the watermark has passed it or not."""
    root = shared_dir(t.spark, label)
    values = [c for c in df.columns if c not in [k.split()[0] for k in keys.split(", ")]]
    table = KeyedTable(t.spark, f"{root}/table", keys, columns, {c: REPLACE for c in values})
    run_to(df, upsert_batches(table), root, "update")
    return table.read()


# ---- aggregates and windows --------------------------------------------------------------------

@query("""SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total,
                 count(*) AS n FROM events GROUP BY user_id""")
def stream_rolling_sum(t: Tables):
    """Update mode: each micro-batch emits the keys it changed, which replace the stored row."""
    root = shared_dir(t.spark, "rolling")
    totals = t.stream("events").groupBy("user_id").agg(money("value", "total"), n_rows())
    table = KeyedTable(t.spark, f"{root}/table", "user_id BIGINT", "total DOUBLE, n BIGINT",
                       {"total": REPLACE, "n": REPLACE})
    run_to(totals, upsert_batches(table), root, "update")
    return table.read()


@query("""SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT)
                 AS total, max(CAST(round(value * 100) AS BIGINT)) OVER w AS highest FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def stream_rolling_trace(t: Tables):
    root = shared_dir(t.spark, "trace")
    rows = t.stream("events").select("event_id", "user_id", cents("value").alias("c"))
    return traced_batches(
        rows, root, lambda df, deliver: run_to(df, deliver, root), keys=["user_id"],
        order=["event_id"], measures={"total": ("sum", "c"), "highest": ("max", "c")}).drop("c")


@query("""SELECT event_id, user_id, value, max(value) OVER
            (PARTITION BY user_id ORDER BY event_id) AS running_max FROM events""")
def stream_running_max(t: Tables):
    rows = t.stream("events").select("event_id", "user_id", "value")
    return finish(t.spark, stateful.running_max(rows, ["user_id"], "event_id", "value"), "max")


@query(f"""SELECT event_type, s AS window_start, s + INTERVAL 1 HOUR AS window_end, n, max_value,
                  min_value FROM (
             SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS n,
                    max(value) AS max_value, min(value) AS min_value FROM events GROUP BY ALL)""")
def stream_tumbling(t: Tables):
    out = closed_events(t, lambda rows: window_totals(
        rows, "ts", "1 hour", ["event_type"], [n_rows(), F.max("value").alias("max_value"),
                                               F.min("value").alias("min_value")]), "tumbling")
    return plain_times(out, "window_start", "window_end")


@query(f"""SELECT event_type, s AS window_start, s + INTERVAL 1 HOUR AS window_end, n
           FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS n
                 FROM events GROUP BY ALL)""")
def stream_tumbling_sql(t: Tables):
    """SQL text over a streaming view."""
    def by_sql(rows):
        rows.createOrReplaceTempView("event_stream")
        return t.spark.sql("""
            SELECT event_type, window.start AS window_start, window.end AS window_end, count(*) AS n
            FROM event_stream GROUP BY event_type, window(ts, '1 hour')""")
    return plain_times(closed_events(t, by_sql, "sql"), "window_start", "window_end")


@query(f"""SELECT event_type, s AS window_start, s + INTERVAL 6 HOUR AS window_end, count(*) AS n
           FROM (SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts) - INTERVAL (3 * k) HOUR AS s
                 FROM events, (VALUES (0), (1)) AS o(k)) GROUP BY ALL""")
def stream_sliding(t: Tables):
    out = closed_events(t, lambda rows: window_totals(
        rows, "ts", "6 hours", ["event_type"], [n_rows()], slide="3 hours"), "sliding")
    return plain_times(out, "window_start", "window_end")


@query(f"""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end,
                  count(*) AS n
           FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY event_id) s
                 FROM (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id
                              ORDER BY event_id) + INTERVAL 6 HOUR, TRUE) AS fresh FROM events))
           GROUP BY user_id, s""")
def stream_session(t: Tables):
    out = closed_events(t, lambda rows: session_totals(
        rows, "ts", "6 hours", ["user_id"], {"n": ("count", None)}), "session")
    return plain_times(out, "session_start", "session_end")


WINDOW_KEYS = "event_type STRING, window_start TIMESTAMP, window_end TIMESTAMP"


@query("""SELECT event_type, s AS window_start, s + INTERVAL 1 HOUR AS window_end, n, max_value,
                 min_value FROM (
            SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS n,
                   max(value) AS max_value, min(value) AS min_value FROM events GROUP BY ALL)""")
def stream_tumbling_whole(t: Tables):
    out = window_totals(timed(t), "ts", "1 hour", ["event_type"],
                        [n_rows(), F.max("value").alias("max_value"),
                         F.min("value").alias("min_value")])
    out = run_keyed(t, out, "tumbling-whole", WINDOW_KEYS,
                    "n BIGINT, max_value DOUBLE, min_value DOUBLE")
    return plain_times(out, "window_start", "window_end")


@query("""SELECT event_type, s AS window_start, s + INTERVAL 1 HOUR AS window_end, n
          FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS s, count(*) AS n
                FROM events GROUP BY ALL)""")
def stream_tumbling_sql_whole(t: Tables):
    timed(t).createOrReplaceTempView("event_stream_whole")
    out = t.spark.sql("""
        SELECT event_type, window.start AS window_start, window.end AS window_end, count(*) AS n
        FROM event_stream_whole GROUP BY event_type, window(ts, '1 hour')""")
    out = run_keyed(t, out, "sql-whole", WINDOW_KEYS, "n BIGINT")
    return plain_times(out, "window_start", "window_end")


@query("""SELECT event_type, s AS window_start, s + INTERVAL 6 HOUR AS window_end, count(*) AS n
          FROM (SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts) - INTERVAL (3 * k) HOUR AS s
                FROM events, (VALUES (0), (1)) AS o(k)) GROUP BY ALL""")
def stream_sliding_whole(t: Tables):
    out = window_totals(timed(t), "ts", "6 hours", ["event_type"], [n_rows()], slide="3 hours")
    out = run_keyed(t, out, "sliding-whole", WINDOW_KEYS, "n BIGINT")
    return plain_times(out, "window_start", "window_end")


@query("""SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end,
                 count(*) AS n
          FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY event_id) s
                FROM (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id
                             ORDER BY event_id) + INTERVAL 6 HOUR, TRUE) AS fresh FROM events))
          GROUP BY user_id, s""")
def stream_session_whole(t: Tables):
    """Session windows have no update mode: every micro-batch gives all sessions, the last one counts."""
    root = shared_dir(t.spark, "session-whole")
    out = session_totals(timed(t), "ts", "6 hours", ["user_id"], {"n": ("count", None)})
    run_to(out, lambda batch, batch_id: batch.write.mode("overwrite").parquet(
        f"{root}/out/batch_id={batch_id}"), root, "complete")
    stored = t.spark.read.parquet(f"{root}/out")
    last = stored.agg(F.max("batch_id").alias("batch_id"))
    return plain_times(stored.join(F.broadcast(last), "batch_id").drop("batch_id"),
                       "session_start", "session_end")


@query("""SELECT event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE)
          / 100 AS total FROM events GROUP BY event_type""")
def stream_arrival_windows(t: Tables):
    """Processing-time windows: which window a row meets depends on the clock, the sum does not."""
    root = shared_dir(t.spark, "arrival")
    out = arrival_totals(t.stream("events"), "5 seconds", ["event_type"],
                         [n_rows(), F.sum(cents("value")).alias("c")])
    table = KeyedTable(t.spark, f"{root}/table", "event_type STRING, window_start TIMESTAMP",
                       "n BIGINT, c BIGINT", {"n": REPLACE, "c": REPLACE})
    run_to(out.drop("window_end"), upsert_batches(table), root, "update")
    return table.read().groupBy("event_type").agg(
        F.sum("n").alias("n"), from_cents(F.sum("c")).alias("total"))


@query("""SELECT DISTINCT user_id, event_type FROM events WHERE value > 100
          UNION SELECT user_id, event_type FROM events WHERE event_type = 'view'""")
def stream_union_distinct(t: Tables):
    rows = t.stream("events")
    high = rows.where("value > 100").select("user_id", "event_type")
    views = t.stream("events").where("event_type = 'view'").select("user_id", "event_type")
    return finish(t.spark, union_distinct(high, views), "union", "update")


# ---- joins -------------------------------------------------------------------------------------

def order_streams(t: Tables):
    # The files are in no order of time; the bound exceeds the span of the tables, so that no row
    # counts as late.
    lines = t.stream("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = t.stream("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (event_time(lines, "l_shipdate", "4000 days"),
            event_time(orders, "o_orderdate", "4000 days"))


@query("""SELECT l_orderkey, l_linenumber, o_custkey, w AS window_start
          FROM (SELECT *, epoch_us(l_shipdate) // 2419200000000 AS v,
                make_timestamp((epoch_us(l_shipdate) // 2419200000000) * 2419200000000) AS w
                FROM lineitem)
          JOIN orders ON l_orderkey = o_orderkey AND v = epoch_us(o_orderdate) // 2419200000000""")
def stream_window_join(t: Tables):
    lines, orders = order_streams(t)
    joined = window_join(lines, orders, {"l_orderkey": "o_orderkey"}, "l_shipdate", "o_orderdate",
                         "28 days")
    out = joined.select("l_orderkey", "l_linenumber", "o_custkey", "window_start")
    return plain_times(finish(t.spark, out, "window-join", conf=INNER_JOIN), "window_start")


@query("""SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders
          ON l_orderkey = o_orderkey
          AND o_orderdate BETWEEN l_shipdate - INTERVAL 60 DAY AND l_shipdate + INTERVAL 30 DAY""")
def stream_interval_join(t: Tables):
    lines, orders = order_streams(t)
    joined = interval_join(lines, orders, {"l_orderkey": "o_orderkey"}, "l_shipdate",
                           "o_orderdate", "-60 days", "30 days")
    return finish(t.spark, joined.select("l_orderkey", "l_linenumber", "o_custkey"),
                  "interval-join", conf=INNER_JOIN)


@query("""SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer
          ON o_custkey = c_custkey""")
def stream_enriched(t: Tables):
    """The dimension is read anew for every micro-batch."""
    root = shared_dir(t.spark, "enriched")
    deliver = enrich_to(f"{root}/out", lambda: t.customer, {"o_custkey": "c_custkey"},
                        ["c_name", "c_mktsegment"])
    run_to(t.stream("orders").select("o_orderkey", "o_custkey"), deliver, root)
    return t.spark.read.parquet(f"{root}/out").drop("batch_id", "o_custkey")


# ---- keyed state -------------------------------------------------------------------------------

@query(f"""SELECT event_id, is_new, is_hour_new, is_day_new, is_month_new FROM ({NEWNESS_SQL})""")
def stream_newness(t: Tables):
    rows = t.stream("events").select("event_id", "user_id", "event_type",
                                     instant("ts").alias("ts"))
    out = stateful.newness(rows, ["user_id", "event_type"], "ts", "event_id")
    return finish(t.spark, out, "newness").drop("user_id", "event_type", "ts")


@query("""WITH r AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS c,
                CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id
                     ORDER BY event_id) AS BIGINT) AS s FROM events)
          SELECT user_id, event_id, 2 AS step, TRUE AS is_add, s AS total FROM r
          UNION ALL SELECT user_id, event_id, 1, FALSE, s - c FROM r
          WHERE event_id NOT IN (SELECT min(event_id) FROM events GROUP BY user_id)""")
def stream_changelog(t: Tables):
    rows = t.stream("events").select("user_id", "event_id", cents("value").alias("c"))
    return finish(t.spark, stateful.changelog(rows, ["user_id"], "event_id", "c"), "changelog")


@query("""SELECT user_id, CAST(event_id AS VARCHAR) AS order_id,
                 CASE WHEN event_id % 3 = 0 THEN 'reviewed' ELSE 'auto' END AS status
          FROM events WHERE event_type = 'purchase'""")
def stream_auto_review(t: Tables):
    """Purchases are orders; every third gets a review half an hour later. Event-time timers."""
    rows = t.stream("events").select("user_id", "event_id", "event_type", instant("ts").alias("ts"))
    order = F.struct(F.lit("order").alias("kind"), F.lit(0).alias("after"))
    review = F.struct(F.lit("review").alias("kind"), F.lit(1800).alias("after"))
    is_order = F.col("event_type") == "purchase"
    made = F.when(is_order & (F.col("event_id") % 3 == 0), F.array(order, review)).when(
        is_order, F.array(order)).otherwise(F.array().cast("array<struct<kind:string,after:int>>"))

    def reviews(marked):
        # The watermark stands on the event itself, so every event moves the clock.
        both = marked.select("user_id", F.col("event_id").cast("string").alias("order_id"), "ts",
                             F.inline_outer(made)).where("kind IS NOT NULL")
        return stateful.review_timers(both.select("user_id", "order_id", "kind", "ts", "after"), "2 hours")

    return closed(t.spark, rows, "ts", reviews, "1 hour", "review")


# ---- applications ------------------------------------------------------------------------------

@query(WORDS_SQL.format(where=""))
def stream_word_count(t: Tables):
    """Exactly-once word count: every micro-batch adds its own counts, fenced by its id."""
    root = shared_dir(t.spark, "words")
    table = KeyedTable(t.spark, f"{root}/table", "word STRING", "n BIGINT", {"n": ADD})
    run_to(t.stream("documents"),
           lambda batch, batch_id: table.upsert(count_words(batch, "text"), batch_id), root)
    return table.read()


@query(DASHBOARD_SQL.format(sales="""SELECT ts, event_type AS category,
    CAST(round(value * 100) AS BIGINT) AS c FROM events"""))
def stream_dashboard(t: Tables):
    """Running totals of open days in update mode; the second level reads the merged table."""
    root = shared_dir(t.spark, "dashboard")
    totals = window_totals(event_time(t.stream("events"), "ts", "1 day"), "ts", "1 day",
                           ["event_type"], [exact_sum("value", 2).alias("total")],
                           offset=local_day_offset(8))
    table = KeyedTable(
        t.spark, f"{root}/table",
        "event_type STRING, window_start TIMESTAMP, window_end TIMESTAMP", "total DOUBLE",
        {"total": REPLACE})
    run_to(totals, upsert_batches(table), root, "update")
    return plain_times(dashboard(table.read(), "event_type"), "window_start", "window_end")


@query("""SELECT event_type AS "channelID", count(*) AS visited FROM events GROUP BY ALL""")
def stream_channel_heat(t: Tables):
    """Visits of closed 10 s windows, added up per channel."""
    clicks = clicklog.messages(click_lines(t.stream("events")))
    heat = closed(t.spark, clicks, "ts", clicklog.channel_heat, "5 seconds", "heat")
    return heat.groupBy("channelID").agg(F.sum("visited").alias("visited"))


@query("""SELECT event_type AS "channelID", count(*) AS visited FROM events GROUP BY ALL""")
def stream_channel_heat_whole(t: Tables):
    """Visits of all 10 s windows, open ones included, kept per window and added up per channel."""
    clicks = clicklog.messages(click_lines(t.stream("events"))).withWatermark("ts", "5 seconds")
    heat = run_keyed(t, clicklog.channel_heat(clicks), "heat-whole",
                     "channelID STRING, window_start TIMESTAMP, window_end TIMESTAMP", "visited BIGINT")
    return heat.groupBy("channelID").agg(F.sum("visited").alias("visited"))


@query(f"""SELECT event_type || ':' || period AS rowkey, count(*) AS pv,
                  CAST(sum(uv) AS BIGINT) AS uv
           FROM (SELECT event_type, strftime(ts, '%Y%m%d%H') AS period, is_hour_new AS uv
                 FROM ({NEWNESS_SQL}) UNION ALL
                 SELECT event_type, strftime(ts, '%Y%m%d'), is_day_new FROM ({NEWNESS_SQL})
                 UNION ALL SELECT event_type, strftime(ts, '%Y%m'), is_month_new
                 FROM ({NEWNESS_SQL})) GROUP BY ALL""")
def stream_channel_pvuv(t: Tables):
    """Wide rows by keyed state, then PV and UV per channel and period added up."""
    root = shared_dir(t.spark, "pvuv")
    clicks = clicklog.messages(click_lines(t.stream("events")))
    wide = clicklog.stream_wide_rows(clicks)
    periods = clicklog.channel_periods(wide)
    table = KeyedTable(t.spark, f"{root}/table", "rowkey STRING", "pv BIGINT, uv BIGINT",
                       {"pv": ADD, "uv": ADD})
    keyed = periods.select(pair_text("channelID", "period").alias("rowkey"), "pv", "uv")
    run_to(keyed, upsert_batches(table), root)
    return table.read()


@query("""SELECT user_id, event_id AS page_id, 'success' AS status FROM events
          WHERE event_type <> 'error'""")
def stream_etl(t: Tables):
    """JSON feed in, JSON lines out."""
    root = shared_dir(t.spark, "etl")
    status = F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("status")
    feed = t.stream("events").select(F.col("user_id").cast("string").alias("user_id"),
                                     F.col("event_id").cast("string").alias("page_id"), status)
    kept = etl.successes(etl.parse_feed(etl.feed_lines(feed)))
    to_files(etl.feed_lines(kept), f"{root}/out", f"{root}/checkpoint", "text").awaitTermination()
    return etl.parse_feed(t.spark.read.text(f"{root}/out"))


@query("""SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tag, count(*) AS n
          FROM events GROUP BY 1""")
def stream_side_outputs(t: Tables):
    root = shared_dir(t.spark, "sides")
    even = F.col("event_id") % 2 == 0
    run_to(t.stream("events"), routed_batches({"even": even, "odd": ~even}, root), root)
    parts = [t.spark.read.parquet(f"{root}/{tag}").groupBy(F.lit(tag).alias("tag")).agg(n_rows())
             for tag in ("even", "odd")]
    return parts[0].unionByName(parts[1])


@query("""SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, max(event_id) AS last_id
          FROM events GROUP BY 1""")
def stream_dated_files(t: Tables):
    root = shared_dir(t.spark, "dated")
    rows = with_date(t.stream("events").select("event_id", "ts"), "ts")
    (rows.writeStream.outputMode("append").format("parquet").partitionBy("dt")
     .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    stored = t.spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return (stored.parquet(f"{root}/out").groupBy(F.col("dt").cast("string").alias("dt"))
            .agg(n_rows(), F.max("event_id").alias("last_id")))
