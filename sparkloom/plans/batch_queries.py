"""Batch queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.json import json_field, parse_nested, row_json
from sparkloom.functions.maps import literal_map, map_get
from sparkloom.functions.numbers import (cents, from_cents, is_even, larger, money_product,
                                         round_half_up, to_number)
from sparkloom.functions.text import blank_as, missing_as, pair_text
from sparkloom.functions.time import format_millis, later_at_grain
from sparkloom.operators.changelog import changelog
from sparkloom.operators.joins import last_per_key, lookup_join
from sparkloom.operators.lateness import lateness_totals, tag_lateness, watermark_audit
from sparkloom.operators.lookups import service_lookup
from sparkloom.operators.newness import newness
from sparkloom.operators.partitioning import by_rule, rebalance, rows_per_partition
from sparkloom.operators.ranking import category_totals, top, top_per_group
from sparkloom.operators.reduce import Reduce, aggregate_by_key
from sparkloom.operators.rows import (as_pairs, drop_containing, keep_any, parse_csv, route,
                                      tag_rows, view_of)
from sparkloom.operators.running import running_max, running_sum
from sparkloom.operators.sets import map_to_common, union_all, union_distinct
from sparkloom.operators.user_functions import flat_map, keep_rows, map_values
from sparkloom.operators.windows import (count_windows, first_in_window, session_totals,
                                         window_elements, window_totals)
from sparkloom.plans import clicklog, etl, traffic
from sparkloom.plans.facts import facts_by_interval, facts_by_window
from sparkloom.plans.festival import daily_dashboard
from sparkloom.plans.registry import Tables, query
from sparkloom.plans.reviews import auto_reviews, review_status
from sparkloom.plans.word_count import word_count as count_words
from sparkloom.session import stored
from sparkloom.tables import wall_clock


def n_rows():
    return F.count(F.lit(1)).alias("n")


def money(col: str, name: str):
    return from_cents(F.sum(cents(col))).alias(name)


# ---- words, projections, filters ---------------------------------------------------------------

WORDS_SQL = """
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents
  WHERE text = '' OR rtrim(text, ' ') <> '') {where} GROUP BY word"""


@query(WORDS_SQL.format(where=""))
def word_count(t: Tables):
    return count_words(t.documents, "text")


@query(WORDS_SQL.format(where="WHERE NOT contains(word, 'the') AND NOT contains(word, 'ion')"))
def word_count_filtered(t: Tables):
    return count_words(t.documents, "text", blocked=["the", "ion"])


@query("""SELECT o_orderkey, o_orderpriority FROM orders
          WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH'""")
def equality_filter(t: Tables):
    return keep_any(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "o_orderpriority")


@query("SELECT doc_id, source FROM documents WHERE NOT contains(text, 'the')")
def blocked_text_filter(t: Tables):
    return drop_containing(t.documents, "text", ["the"]).select("doc_id", "source")


@query("SELECT event_id, value FROM events WHERE value > 10")
def numeric_filter(t: Tables):
    return t.events.where(F.col("value") > 10).select("event_id", "value")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
                 l_returnflag || l_linestatus AS flags FROM lineitem""")
def projection(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.concat("l_returnflag", "l_linestatus").alias("flags"))


@query("""SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS tag,
                 count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1""")
def side_outputs(t: Tables):
    parts = route(t.events.select("event_id"),
                  {"even": is_even("event_id"), "odd": ~is_even("event_id")})
    counted = [part.agg(F.lit(tag).alias("tag"), n_rows(), F.max("event_id").alias("last_id"))
               for tag, part in parts.items()]
    return union_all(*counted)


@query("""SELECT event_id, CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'middle'
                           ELSE 'low' END AS tag FROM events""")
def tagged_rows(t: Tables):
    value = F.col("value")
    return tag_rows(t.events.select("event_id", "value"),
                    {"high": value > 50, "middle": value > 10}, default="low").drop("value")


@query("""SELECT 'p' || l_partkey AS sensor, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS n
          FROM lineitem GROUP BY 1""")
def sensor_lines(t: Tables):
    lines = t.lineitem.select(F.concat_ws(
        ",", F.concat(F.lit("p"), F.col("l_partkey")), F.col("l_quantity").cast("int"))
        .alias("value"))
    return (parse_csv(lines, "value", "sensor STRING, count INT")
            .groupBy("sensor").agg(F.sum("count").alias("n")))


@query("""SELECT 'u' || user_id AS sensor, time_bucket(INTERVAL 6 HOUR, ts) AS window_start,
                 time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
                 CAST(sum(CAST(floor(value) AS INT)) AS BIGINT) AS count
          FROM events GROUP BY ALL""")
def traffic_counts(t: Tables):
    """Lines are parsed, then counted per sensor and window."""
    line = F.concat_ws(",", F.concat(F.lit("u"), F.col("user_id")),
                       F.floor("value").cast("string"))
    lines = t.events.select("ts", line.alias("value"))
    read = lines.select("ts", F.from_csv("value", traffic.LINE).alias("r")).select("ts", "r.*")
    return traffic.tumbling(read, "ts", "6 hours")


@query("""SELECT event_id, value * 2 + 1 AS doubled, n FROM events, (VALUES (1), (2)) AS o(n)
          WHERE value > 10""")
def user_functions(t: Tables):
    """The same by user code: a filter, a column and two rows for one."""
    kept = keep_rows(t.events.select("event_id", "value"), lambda v: v > 10, "value")
    doubled = kept.select("event_id", map_values(lambda v: v * 2 + 1, "double", "value")
                          .alias("doubled"))

    def twice(frame):
        for n in (1, 2):
            yield frame.assign(n=n)

    return flat_map(doubled, twice, "event_id BIGINT, doubled DOUBLE, n INT")


@query("""SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)
          AS total FROM events GROUP BY user_id""")
def json_parse(t: Tables):
    return (t.events.select("user_id", json_field("props", "k", "bigint").alias("k"))
            .groupBy("user_id").agg(F.sum("k").alias("total")))


@query("""SELECT CAST(event_id AS VARCHAR) AS id, event_type AS channel,
                 CAST(user_id AS VARCHAR) AS visitor, CAST(1 AS BIGINT) AS count,
                 epoch_us(ts) // 1000 AS ts_ms FROM events""")
def nested_json(t: Tables):
    inner = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("channel"),
                               F.col("user_id").alias("visitor")))
    outer = t.events.select(F.lit(1).alias("count"),
                            F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
                            inner.alias("body"))
    lines = outer.select(row_json(outer).alias("value"))
    parsed = parse_nested(lines, "value", "count BIGINT, ts_ms BIGINT, body STRING", "body",
                          "id STRING, channel STRING, visitor STRING")
    return parsed.select("body.*", "count", "ts_ms")


@query("SELECT event_type || ':' || count(*) AS value FROM events GROUP BY event_type")
def pair_texts(t: Tables):
    return as_pairs(t.events.groupBy("event_type").agg(n_rows()), "event_type", "n")


# ---- scalar functions --------------------------------------------------------------------------

@query("""SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d%H') AS hour,
                 strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS day,
                 strftime(ts + INTERVAL 8 HOUR, '%Y%m') AS month,
                 strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc, strftime(ts, '%H:%M:%S') AS clock,
                 CAST(date_trunc('day', ts) > TIMESTAMP '2024-01-15' AS INT) AS later
          FROM events""")
def time_texts(t: Tables):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    df = t.events.select("event_id", "ts", ms.alias("ms"))
    return df.select(
        "event_id", format_millis("ms", "yyyyMMddHH", "Asia/Shanghai").alias("hour"),
        format_millis("ms", "yyyyMMdd", "Asia/Shanghai").alias("day"),
        format_millis("ms", "yyyyMM", "Asia/Shanghai").alias("month"),
        format_millis("ms", "yyyy-MM-dd HH:mm:ss").alias("utc"),
        format_millis("ms", "HH:mm:ss").alias("clock"),
        later_at_grain("ts", F.lit("2024-01-15 10:00:00").cast("timestamp_ntz"), "day")
        .alias("later"))


@query("""SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,0))
                 * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_money,
                 round(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                       / 7.0, 2) AS seventh
          FROM lineitem GROUP BY l_partkey""")
def money_math(t: Tables):
    df = t.lineitem.select("l_partkey", money_product("l_quantity", "l_extendedprice").alias("m"),
                           cents("l_extendedprice").alias("c"))
    return df.groupBy("l_partkey").agg(
        F.sum("m").cast("double").alias("total_money"),
        round_half_up(F.sum("c") / F.lit(7.0)).alias("seventh"))


@query("""SELECT turn, conv_id, coalesce(nullif(trim(CASE WHEN role = 'user' THEN '  '
                 ELSE role END), ''), 'nobody') AS speaker,
                 coalesce(CASE WHEN turn > 1 THEN turn END, 0) AS later_turn,
                 TRY_CAST(CASE WHEN role = 'user' THEN 'x' ELSE CAST(turn AS VARCHAR) END
                          AS BIGINT) AS number,
                 greatest(turn, 2) AS at_least_two,
                 printf('%s-%05d', role, turn) AS label,
                 CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 0 END AS code
          FROM conversations""")
def scalar_functions(t: Tables):
    role, turn = F.col("role"), F.col("turn")
    user = role == "user"
    return t.conversations.select(
        "turn", "conv_id",
        blank_as(F.when(user, "  ").otherwise(role), "nobody").alias("speaker"),
        missing_as(F.when(turn > 1, turn), 0).alias("later_turn"),
        to_number(F.when(user, "x").otherwise(turn.cast("string")), strict=False).alias("number"),
        larger("turn", F.lit(2)).alias("at_least_two"),
        F.format_string("%s-%05d", "role", "turn").alias("label"),
        map_get(literal_map({"user": 1, "assistant": 2}), "role", 0).alias("code"))


# ---- rolling and grouped aggregates ------------------------------------------------------------

@query("""SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
          FROM events GROUP BY user_id""")
def rolling_sum_final(t: Tables):
    return t.events.groupBy("user_id").agg(money("value", "total"))


@query("""SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER
            (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS running_sum FROM events""")
def rolling_sum_trace(t: Tables):
    df = t.events.select("event_id", "user_id", cents("value").alias("c"))
    return running_sum(df, ["user_id"], ["event_id"], "c").drop("c")


@query("""SELECT event_id, user_id, value, max(value) OVER
            (PARTITION BY user_id ORDER BY event_id) AS running_max FROM events""")
def keyed_running_max(t: Tables):
    return running_max(t.events.select("event_id", "user_id", "value"), ["user_id"],
                       ["event_id"], "value")


@query("""SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)
          AS total_cents FROM orders GROUP BY o_custkey""")
def custom_reduce(t: Tables):
    df = t.orders.select("o_custkey", cents("o_totalprice").alias("c"))
    return aggregate_by_key(df, ["o_custkey"], ["c"], Reduce("c", lambda a, b: a + b),
                            "total_cents BIGINT")


@query("""SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
          AS DOUBLE) / 100 AS total FROM orders GROUP BY o_custkey""")
def sql_group_sum(t: Tables):
    return t.views("orders").sql("""
        SELECT o_custkey, count(*) AS n,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100D AS total
        FROM orders GROUP BY o_custkey""")


@query("SELECT o_custkey, count(*) AS frequency FROM orders GROUP BY o_custkey HAVING count(*) = 10")
def having_count(t: Tables):
    view = view_of(t.orders, "order_keys", "o_custkey")
    return (view.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("frequency"))
            .where("frequency = 10"))


@query("""SELECT o_orderpriority, count(o_orderkey) AS n, max(o_totalprice) AS max_price,
                 min(o_totalprice) AS min_price FROM orders GROUP BY o_orderpriority""")
def count_max_min(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(
        F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS total, 8 AS parts FROM
          (SELECT count(*) AS n FROM lineitem)""")
def rebalanced_rows(t: Tables):
    spread = rows_per_partition(rebalance(t.lineitem.select("l_orderkey"), 8))
    return spread.agg(F.sum("n_rows").alias("total"), F.count(F.lit(1)).cast("int").alias("parts"))


@query("""SELECT CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS partition, event_type,
                 count(*) AS n FROM events GROUP BY 1, 2""")
def custom_partition(t: Tables):
    placed = by_rule(t.events.select("event_type"), 2,
                     F.when(F.col("event_type") == "view", 0).otherwise(1))
    return (placed.groupBy(F.spark_partition_id().alias("partition"), "event_type").agg(n_rows()))


# ---- set operations ----------------------------------------------------------------------------

@query("""SELECT o_custkey AS cust, o_orderpriority AS label FROM orders WHERE o_totalprice > 200000
          UNION SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 1000""")
def union_rows(t: Tables):
    big = t.orders.where("o_totalprice > 200000").select(
        F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("label"))
    rich = t.customer.where("c_acctbal > 1000").select(
        F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("label"))
    return union_distinct(big, rich)


@query("""SELECT key, count(*) AS n FROM (SELECT o_custkey AS key FROM orders
          UNION ALL SELECT c_custkey FROM customer) GROUP BY key""")
def union_all_rows(t: Tables):
    both = union_all(t.orders.select(F.col("o_custkey").alias("key")),
                     t.customer.select(F.col("c_custkey").alias("key")))
    return both.groupBy("key").agg(n_rows())


@query("""SELECT word, count(*) AS n FROM (SELECT CAST(user_id AS VARCHAR) AS word FROM events
          UNION ALL SELECT role FROM conversations) GROUP BY word""")
def connected_map(t: Tables):
    both = map_to_common(t.events, {"word": F.col("user_id").cast("string")},
                         t.conversations, {"word": "role"})
    return both.groupBy("word").agg(n_rows())


# ---- windows -----------------------------------------------------------------------------------

HOURLY_SQL = """
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n,
       max(value) AS max_value, min(value) AS min_value,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
FROM events GROUP BY ALL"""


def hourly_aggs():
    return [n_rows(), F.max("value").alias("max_value"), F.min("value").alias("min_value"),
            money("value", "total")]


@query(HOURLY_SQL)
def tumbling(t: Tables):
    return window_totals(t.events, "ts", "1 hour", ["event_type"], hourly_aggs())


@query(HOURLY_SQL)
def tumbling_sql(t: Tables):
    return t.views("events").sql("""
        SELECT event_type, window.start AS window_start, window.end AS window_end, count(*) AS n,
               max(value) AS max_value, min(value) AS min_value,
               sum(CAST(round(value * 100) AS BIGINT)) / 100D AS total
        FROM events GROUP BY event_type, window(ts, '1 hour')""")


@query(HOURLY_SQL)
def tumbling_dsl(t: Tables):
    view = view_of(t.events, "event_values", "event_type", "ts", "value")
    return (view.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(*hourly_aggs())
            .select("event_type", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "n", "max_value", "min_value", "total"))


@query("""SELECT event_type, s AS window_start, s + INTERVAL 6 HOUR AS window_end, count(*) AS n
          FROM (SELECT event_type, time_bucket(INTERVAL 3 HOUR, ts) - INTERVAL (3 * k) HOUR AS s
                FROM events, (VALUES (0), (1)) AS o(k)) GROUP BY ALL""")
def sliding(t: Tables):
    return window_totals(t.events, "ts", "6 hours", ["event_type"], [n_rows()], slide="3 hours")


SESSION_SQL = """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end,
       count(*) AS n, max(value) AS max_value
FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
      FROM (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                               + INTERVAL 6 HOUR, TRUE) AS fresh FROM events))
GROUP BY user_id, s"""


@query(SESSION_SQL)
def session(t: Tables):
    return session_totals(t.events, "ts", "6 hours", ["user_id"],
                          {"n": ("count", None), "max_value": ("max", "value")})


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR
                 AS window_start, time_bucket(INTERVAL 1 DAY, ts + INTERVAL 8 HOUR)
                 + INTERVAL 16 HOUR AS window_end, count(*) AS n FROM events GROUP BY ALL""")
def local_day(t: Tables):
    return window_totals(t.events, "ts", "1 day", ["event_type"], [n_rows()], offset="-8 hours")


@query("""SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                 time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                 CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total,
                 min_by(event_type, event_id) AS event_type, min(event_id) AS event_id
          FROM events GROUP BY ALL""")
def window_sum_first(t: Tables):
    # Rows are in order of time by event_id.
    return window_totals(t.events, "ts", "1 day", ["user_id"],
                         [money("value", "total"), first_in_window("event_type", "event_id"),
                          first_in_window("event_id", "event_id")])


WINDOW_REPORT = """
    SELECT user_id, part, any_value(n) AS n_elements, s AS window_start,
           s + INTERVAL 1 DAY AS window_end,
           'key:' || user_id || ' window:[00:00:00~00:00:00) times:['
             || string_agg(strftime(ts, '%H:%M:%S'), ', ' ORDER BY ts, event_id) || ']' AS report
    FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS s, count(*) OVER w AS n,
                 CAST((row_number() OVER (w ORDER BY ts, event_id) - 1) // {rows} AS INTEGER) AS part
          FROM events WINDOW w AS (PARTITION BY user_id, time_bucket(INTERVAL 1 DAY, ts)))
    GROUP BY user_id, part, s"""


@query(WINDOW_REPORT.format(rows=10_000))
def window_report(t: Tables):
    return window_elements(t.events, "ts", "1 day", "user_id", ["ts", "event_id"],
                           part_rows=10_000)


@query(WINDOW_REPORT.format(rows=2))
def window_report_parts(t: Tables):
    # Windows that span several parts.
    return window_elements(t.events, "ts", "1 day", "user_id", ["ts", "event_id"], part_rows=2)


@query("""SELECT user_id, firing, count(*) AS n, max(event_id) AS last_id FROM (
            SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) + 9) // 10
            AS firing FROM events) GROUP BY user_id, firing HAVING count(*) = 10""")
def count_window(t: Tables):
    return count_windows(t.events, ["user_id"], ["event_id"], 10,
                         [n_rows(), F.max("event_id").alias("last_id")])


@query("""WITH r AS (SELECT user_id, event_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
               f AS (SELECT *, (rn + 3) // 4 + k AS firing FROM r, (VALUES (0), (1), (2)) o(k))
          SELECT user_id, firing, count(*) AS n, max(event_id) AS last_id FROM f
          WHERE rn > firing * 4 - 10 GROUP BY user_id, firing HAVING max(rn) = firing * 4""")
def count_window_sliding(t: Tables):
    return count_windows(t.events, ["user_id"], ["event_id"], 10,
                         [n_rows(), F.max("event_id").alias("last_id")], slide=4)


# ---- joins and lookups -------------------------------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, o_custkey,
                 CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(o_totalprice AS DECIMAL(18,2))
                      AS DOUBLE) AS total_money, w AS window_start,
                 w + INTERVAL 28 DAY AS window_end
          FROM (SELECT *, make_timestamp((epoch_us(l_shipdate) // 2419200000000) * 2419200000000)
                AS w FROM lineitem)
          JOIN (SELECT *, make_timestamp((epoch_us(o_orderdate) // 2419200000000) * 2419200000000)
                AS v FROM orders) ON l_orderkey = o_orderkey AND w = v""")
def window_joined(t: Tables):
    joined = facts_by_window(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"),
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        {"l_orderkey": "o_orderkey"}, "l_shipdate", "o_orderdate", "28 days",
        "l_quantity", "o_totalprice")
    return joined.select("l_orderkey", "l_linenumber", "o_custkey",
                         F.col("total_money").cast("double").alias("total_money"),
                         "window_start", "window_end")


@query("""SELECT l_orderkey, l_linenumber, o_custkey, l_shipdate, o_orderdate,
                 CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(o_totalprice AS DECIMAL(18,2))
                      AS DOUBLE) AS total_money
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           AND o_orderdate BETWEEN l_shipdate - INTERVAL 60 DAY AND l_shipdate + INTERVAL 30 DAY""")
def interval_joined(t: Tables):
    joined = facts_by_interval(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"),
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
        {"l_orderkey": "o_orderkey"}, "l_shipdate", "o_orderdate", "-60 days", "30 days",
        "l_quantity", "o_totalprice")
    return joined.select("l_orderkey", "l_linenumber", "o_custkey", "l_shipdate", "o_orderdate",
                         F.col("total_money").cast("double").alias("total_money"))


@query("""SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
          FROM documents LEFT JOIN labels USING (doc_id)""")
def default_lookup(t: Tables):
    return lookup_join(t.documents.select("doc_id", "lang"), t.labels, {"doc_id": "doc_id"},
                       ["quality", "toxic"], missing={"quality": -1, "toxic": -1})


@query("""SELECT o_orderkey, c_name, c_mktsegment, n_name FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def enriched_orders(t: Tables):
    # Nations are a fixed, counted handful; customers grow, so the optimizer decides.
    customers = lookup_join(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"],
                            missing="inner", broadcast_rows=1_000)
    return lookup_join(t.orders.select("o_orderkey", "o_custkey"), customers,
                       {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "n_name"],
                       missing="fail").drop("o_custkey")


@query("""SELECT o_custkey, o_orderkey AS last_order, o_orderpriority FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def last_duplicate(t: Tables):
    df = t.orders.select("o_custkey", F.col("o_orderkey").alias("last_order"), "o_orderpriority")
    return last_per_key(df, ["o_custkey"], "last_order")


def _name_service():
    return lambda key: None if key % 7 == 0 else f"user_{key}"


@query("""SELECT event_id, user_id, CASE WHEN user_id % 7 <> 0 THEN 'user_' || user_id END AS name
          FROM events""")
def service_names(t: Tables):
    return service_lookup(t.events.select("event_id", "user_id"), "user_id", "name",
                          _name_service)


# ---- ranking, dashboard, reviews ---------------------------------------------------------------

@query("""SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type,
                 total, rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY window_start
                      ORDER BY total DESC, event_type) AS INT) AS rank
            FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type,
                  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
                  FROM events GROUP BY ALL)) WHERE rank <= 3""")
def category_top(t: Tables):
    totals = category_totals(t.events, "event_type", "value", "ts", decimals=2)
    return top_per_group(totals, ["window_start", "window_end"], "total", "event_type", 3)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def highest_orders(t: Tables):
    return top(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 10)


DASHBOARD_SQL = """
WITH sales AS ({sales}),
totals AS (SELECT time_bucket(INTERVAL 1 DAY, ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR
             AS window_start, category, CAST(sum(c) AS BIGINT) AS cents
           FROM sales GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cents DESC, category)
             AS rank FROM totals)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end,
       round(CAST(sum(cents) AS DOUBLE) / 100, 2) AS total,
       string_agg(category || '=' || CAST(CAST(cents AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2)),
                  chr(10) ORDER BY rank) FILTER (rank <= 3) AS top_categories
FROM ranked GROUP BY window_start"""


@query(DASHBOARD_SQL.format(sales="""SELECT ts, event_type AS category,
    CAST(round(value * 100) AS BIGINT) AS c FROM events"""))
def event_dashboard(t: Tables):
    return daily_dashboard(t.events, "event_type", "value", "ts", decimals=2)


@query(DASHBOARD_SQL.format(sales="""SELECT l_shipdate AS ts, p_brand AS category,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem JOIN part
    ON l_partkey = p_partkey"""))
def festival_dashboard(t: Tables):
    sales = lookup_join(t.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice"), t.part,
                        {"l_partkey": "p_partkey"}, ["p_brand"], missing="inner")
    return daily_dashboard(sales, "p_brand", "l_extendedprice", "l_shipdate", decimals=2)


@query("""WITH n AS (SELECT max(o_orderdate) AS now FROM orders)
          SELECT o_orderkey, CASE
            WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
                         AND l_returnflag = 'R') THEN 'reviewed'
            WHEN o_orderdate + INTERVAL 30 DAY <= (SELECT now FROM n) THEN 'auto'
            ELSE 'pending' END AS status FROM orders""")
def review_states(t: Tables):
    # Returned lines stand for reviews; the clock stands at the last order.
    now = t.orders.agg(F.max("o_orderdate")).scalar()
    return review_status(t.orders.select("o_orderkey", "o_orderdate"),
                         t.lineitem.where("l_returnflag = 'R'"), "o_orderkey", "l_orderkey",
                         "o_orderdate", now, "30 days").drop("o_orderdate")


@query("""SELECT o_orderkey, o_custkey FROM orders
          WHERE o_orderdate + INTERVAL 30 DAY <= (SELECT max(o_orderdate) FROM orders)
            AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def auto_review(t: Tables):
    now = t.orders.agg(F.max("o_orderdate")).scalar()
    return auto_reviews(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                        t.lineitem.where("l_returnflag = 'R'"), "o_orderkey", "l_orderkey",
                        "o_orderdate", now, "30 days").drop("o_orderdate")


# ---- newness and the click-log warehouse -------------------------------------------------------

NEWNESS_SQL = """
SELECT *, CAST(p IS NULL AS INT) AS is_new,
       CAST(p IS NULL OR date_trunc('hour', ts) > date_trunc('hour', p) AS INT) AS is_hour_new,
       CAST(p IS NULL OR date_trunc('day', ts) > date_trunc('day', p) AS INT) AS is_day_new,
       CAST(p IS NULL OR date_trunc('month', ts) > date_trunc('month', p) AS INT) AS is_month_new
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p
      FROM events)"""


@query(f"""SELECT event_id, is_new, is_hour_new, is_day_new, is_month_new FROM ({NEWNESS_SQL})""")
def newness_flags(t: Tables):
    df = t.events.select("event_id", "user_id", "event_type", "ts")
    flagged = newness(df, ["user_id", "event_type"], "ts", ["ts", "event_id"])
    return flagged.drop("user_id", "event_type", "ts")


def click_lines(events):
    """Events as click messages: the event type is the channel."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(clicklog.click_message(
        F.col("event_id"), ms, channel=F.col("event_type"), user=F.col("user_id")).alias("value"))


def detailed_click_lines(events):
    """Click messages whose every field follows from the event."""
    n, ms = F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp"))

    def one_of(values):
        return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))

    fields = {"categoryID": n % 20 + 1, "produceID": n % 17 + 1, "country": F.lit(clicklog.COUNTRIES[0]),
              "province": one_of(clicklog.PROVINCES), "city": one_of(clicklog.CITIES),
              "network": one_of(clicklog.NETWORKS), "source": one_of(clicklog.SOURCES),
              "browserType": one_of(clicklog.BROWSERS),
              "entryTime": clicklog.LEAVE_TIME - n % 10 * 3_600_000}
    return events.select(clicklog.click_message(
        n, ms, channel=F.col("event_type"), user=F.col("user_id"), fields=fields).alias("value"))


def one_of_sql(values) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"[{listed}][event_id % {len(values)} + 1]"


@query(f"""SELECT event_type AS "channelID", CAST(event_id % 20 + 1 AS VARCHAR) AS "categoryID",
                  CAST(event_id % 17 + 1 AS VARCHAR) AS "produceID", '{clicklog.COUNTRIES[0]}' AS country,
                  {one_of_sql(clicklog.PROVINCES)} AS province, {one_of_sql(clicklog.CITIES)} AS city,
                  {one_of_sql(clicklog.NETWORKS)} AS network, {one_of_sql(clicklog.SOURCES)} AS source,
                  {one_of_sql(clicklog.BROWSERS)} AS "browserType",
                  CAST({clicklog.LEAVE_TIME} - event_id % 10 * 3600000 AS VARCHAR) AS "entryTime",
                  '{clicklog.LEAVE_TIME}' AS "leaveTime", CAST(user_id AS VARCHAR) AS "userID",
                  CAST(1 AS BIGINT) AS "count", epoch_us(ts) // 1000 AS "timestamp",
                  make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts,
                  is_new, is_hour_new, is_day_new, is_month_new,
                  '{clicklog.COUNTRIES[0]}' || {one_of_sql(clicklog.PROVINCES)}
                    || {one_of_sql(clicklog.CITIES)} AS address,
                  strftime(ts, '%Y%m') AS "yearMonth", strftime(ts, '%Y%m%d') AS "yearMonthDay",
                  strftime(ts, '%Y%m%d%H') AS "yearMonthDayHour" FROM ({NEWNESS_SQL})""")
def click_wide(t: Tables):
    # The flags take several passes over the clicks, so the JSON is parsed into a table first.
    clicks = stored(clicklog.messages(detailed_click_lines(t.events)), "clicks")
    return clicklog.wide_rows(clicks).withColumn("ts", wall_clock("ts"))


@query("""SELECT event_type AS "channelID", time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                 time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                 count(*) AS visited FROM events GROUP BY ALL""")
def channel_heat(t: Tables):
    heat = clicklog.channel_heat(clicklog.messages(click_lines(t.events)), "1 hour")
    return heat.withColumns({c: F.col(c).cast("timestamp_ntz")
                             for c in ("window_start", "window_end")})


@query(f"""SELECT event_type AS "channelID", period, count(*) AS pv, CAST(sum(uv) AS BIGINT) AS uv
           FROM (SELECT event_type, strftime(ts, '%Y%m%d%H') AS period, is_hour_new AS uv
                 FROM ({NEWNESS_SQL}) UNION ALL
                 SELECT event_type, strftime(ts, '%Y%m%d'), is_day_new FROM ({NEWNESS_SQL})
                 UNION ALL SELECT event_type, strftime(ts, '%Y%m'), is_month_new
                 FROM ({NEWNESS_SQL})) GROUP BY ALL""")
def channel_pvuv(t: Tables):
    # The flags take several passes over the clicks, so the JSON is parsed into a table first.
    wide = clicklog.wide_rows(stored(clicklog.messages(click_lines(t.events)), "clicks"))
    return (clicklog.channel_periods(wide).groupBy("channelID", "period")
            .agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv")))


@query("""SELECT event_type AS channel, strftime(ts, '%Y%m%d') AS period, count(*) AS pv,
                 count(DISTINCT user_id) AS uv FROM events GROUP BY ALL""")
def distinct_visitors(t: Tables):
    day = F.date_format("ts", "yyyyMMdd").alias("period")
    return t.events.groupBy(F.col("event_type").alias("channel"), day).agg(
        F.count(F.lit(1)).alias("pv"), F.count_distinct("user_id").alias("uv"))


# ---- watermarks, late rows, changelog ----------------------------------------------------------

ARRIVAL_SQL = """
SELECT *, ts + to_seconds(event_id * 7919 % 7200) AS arrival FROM events"""


def arrivals(t: Tables):
    """Events delayed by up to two hours, so that they arrive out of order."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                               (F.col("event_id") * 7919 % 7200).cast("decimal(18,6)"))
    return t.events.select("event_id", "user_id", "event_type", "ts", cents("value").alias("c"),
                           (F.col("ts") + delay).alias("arrival"))


@query(f"""SELECT event_id, max(ts) OVER w AS max_time,
                  max(ts) OVER w - INTERVAL 3 SECOND - INTERVAL 1 MILLISECOND AS watermark
           FROM ({ARRIVAL_SQL}) WINDOW w AS (ORDER BY arrival, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def watermark_trace(t: Tables):
    audit = watermark_audit(arrivals(t).select("event_id", "ts", "arrival"), "ts",
                            ["arrival", "event_id"], "3 seconds")
    return audit.select("event_id", "max_time", "watermark")


LATE_SQL = f"""
SELECT *, CASE WHEN m IS NULL OR m - INTERVAL 10 MINUTE < window_end THEN 'on_time'
               WHEN m - INTERVAL 10 MINUTE < window_end + INTERVAL 30 MINUTE THEN 'update'
               ELSE 'late' END AS lateness
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
             time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             max(ts) OVER (ORDER BY arrival, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
      FROM ({ARRIVAL_SQL}))"""


def tagged_arrivals(t: Tables):
    return tag_lateness(arrivals(t), "ts", ["arrival", "event_id"], "1 hour", "10 minutes",
                        "30 minutes")


@query(f"SELECT event_id, window_start, window_end, lateness FROM ({LATE_SQL}) WHERE lateness = 'late'")
def late_rows(t: Tables):
    return (tagged_arrivals(t).where("lateness = 'late'")
            .select("event_id", "window_start", "window_end", "lateness"))


@query(f"""SELECT event_type, window_start, window_end,
                  CAST(sum(CASE WHEN lateness <> 'late' THEN CAST(round(value * 100) AS BIGINT)
                           ELSE 0 END) AS BIGINT) AS total,
                  count(*) FILTER (lateness = 'on_time') AS n_on_time,
                  count(*) FILTER (lateness = 'update') AS n_updates,
                  count(*) FILTER (lateness = 'late') AS n_late
           FROM ({LATE_SQL}) GROUP BY event_type, window_start, window_end""")
def allowed_lateness(t: Tables):
    return lateness_totals(tagged_arrivals(t), ["event_type"], "c")


@query("""WITH r AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS c,
                CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id
                     ORDER BY event_id) AS BIGINT) AS s FROM events)
          SELECT user_id, event_id, 2 AS step, TRUE AS is_add, s AS total FROM r
          UNION ALL SELECT user_id, event_id, 1, FALSE, s - c FROM r
          WHERE event_id NOT IN (SELECT min(event_id) FROM events GROUP BY user_id)""")
def retract_changelog(t: Tables):
    df = t.events.select("user_id", "event_id", cents("value").alias("c"))
    return changelog(df, ["user_id"], ["event_id"], "c")


# ---- SQL ETL -----------------------------------------------------------------------------------

@query("""SELECT user_id, event_id AS page_id, CASE WHEN event_type = 'error' THEN 'fail'
                 ELSE 'success' END AS status FROM events WHERE event_type <> 'error'""")
def etl_success(t: Tables):
    status = F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("status")
    feed = t.events.select(F.col("user_id").cast("string").alias("user_id"),
                           F.col("event_id").cast("string").alias("page_id"), status)
    kept = etl.successes(etl.parse_feed(etl.feed_lines(feed)))
    return etl.parse_feed(etl.feed_lines(kept))
