"""Sources and sinks: results that went through storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.numbers import cents
from sparkloom.operators.joins import last_per_key, lookup_join
from sparkloom.operators.rows import as_pairs
from sparkloom.plans.batch_queries import n_rows
from sparkloom.plans.registry import Tables, query
from sparkloom.session import shared_dir
from sparkloom.sinks.batches import read_batches, write_once
from sparkloom.sinks.files import write_dated, write_text
from sparkloom.sinks.keyed import ADD, HIGHEST, LOWEST, REPLACE, KeyedTable
from sparkloom.sinks.tables import create_table, insert_into
from sparkloom.sources.json_table import declare
from sparkloom.sources.lines import read_lines
from sparkloom.sources.literals import sequence
from sparkloom.sources.side_file import side_table

YEARS = ["1996-01-01", "1999-01-01"]


def batches_by_date(df, col: str):
    """The whole table as three batches."""
    day = F.col(col)
    first, second = (F.lit(y).cast("timestamp_ntz") for y in YEARS)
    return [df.where(day < first), df.where((day >= first) & (day < second)),
            df.where(day >= second)]


@query("""SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
          AS BIGINT) AS c, max(o_totalprice) AS highest, min(o_totalprice) AS lowest
          FROM orders GROUP BY o_custkey""")
def keyed_add(t: Tables):
    """Additive upserts; one batch is delivered twice, and old batches are compacted."""
    table = KeyedTable(t.spark, shared_dir(t.spark, "keyed"), "o_custkey BIGINT",
                       "n BIGINT, c BIGINT, highest DOUBLE, lowest DOUBLE",
                       {"n": ADD, "c": ADD, "highest": HIGHEST, "lowest": LOWEST})
    rows = t.orders.select("o_custkey", F.lit(1).alias("n"), cents("o_totalprice").alias("c"),
                           F.col("o_totalprice").alias("highest"),
                           F.col("o_totalprice").alias("lowest"), "o_orderdate")
    for batch_id, batch in enumerate(batches_by_date(rows, "o_orderdate")):
        table.upsert(batch, batch_id)
        if batch_id == 1:
            table.upsert(batch, batch_id)
            table.compact(batch_id)
    return table.read()


@query("""SELECT o_custkey, o_orderpriority FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
                                     o_orderkey DESC) = 1""")
def keyed_replace(t: Tables):
    """The latest row of a key replaces the stored one."""
    table = KeyedTable(t.spark, shared_dir(t.spark, "keyed"), "o_custkey BIGINT",
                       "o_orderpriority STRING", {"o_orderpriority": REPLACE})
    rows = t.orders.withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    for batch_id, batch in enumerate(batches_by_date(rows, "o_orderdate")):
        table.upsert(batch, batch_id, order="at")
    return table.read()


@query("""SELECT c_custkey, coalesce(CASE WHEN c_nationkey <> 3 THEN n END, 0) AS n
          FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
          ON c_custkey = o_custkey""")
def keyed_get(t: Tables):
    """Delete some keys, then look all keys up; missing ones give 0."""
    table = KeyedTable(t.spark, shared_dir(t.spark, "keyed"), "c_custkey BIGINT", "n BIGINT",
                       {"n": ADD})
    table.upsert(t.orders.select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("n")), 0)
    table.delete(t.customer.where("c_nationkey = 3"), 1)
    return table.get(t.customer.select("c_custkey"), ["n"], {"n": 0})


@query("SELECT word, count(*) AS n FROM (SELECT event_type || ':' || user_id AS word FROM events) GROUP BY word")
def text_files(t: Tables):
    """Rows to text files and back."""
    path = shared_dir(t.spark, "text")
    write_text(as_pairs(t.events, "event_type", "user_id"), path)
    return read_lines(t.spark, path).groupBy(F.col("value").alias("word")).agg(n_rows())


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, count(*) AS n, max(o_orderkey) AS last_id
          FROM orders GROUP BY 1""")
def dated_files(t: Tables):
    """One folder per month keeps the number of files in hand; the date is read from the rows."""
    path = shared_dir(t.spark, "dated")
    month = F.date_trunc("month", "o_orderdate")
    write_dated(t.orders.withColumn("month", month), path, "month", max_rows_per_file=1_000_000)
    return (t.spark.read.parquet(path)
            .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))
            .agg(n_rows(), F.max("o_orderkey").alias("last_id")))


@query("""SELECT c_custkey, coalesce(CASE WHEN n_nationkey < 20 THEN n_name END, '') AS n_name
          FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def side_file_lookup(t: Tables):
    """A delimited side file; names it lacks are empty, and the last of two lines wins."""
    path = shared_dir(t.spark, "nations")
    known = t.nation.where("n_nationkey < 20").select("n_nationkey", "n_name")
    old = known.select("n_nationkey", F.lit("old name").alias("n_name"))
    old.withColumn("line", F.lit(1)).unionByName(known.withColumn("line", F.lit(2))) \
        .write.csv(path)
    names = side_table(t.spark, path, "n_nationkey INT, n_name STRING, line INT")
    names = last_per_key(names, ["n_nationkey"], "line")
    return lookup_join(t.customer.select("c_custkey", "c_nationkey"), names,
                       {"c_nationkey": "n_nationkey"}, ["n_name"], missing={"n_name": ""},
                       broadcast_rows=1_000).drop("c_nationkey")


@query("""SELECT status, count(*) AS n, max(page_id) AS last_id FROM (
            SELECT event_id AS page_id, event_type AS status FROM events) GROUP BY status""")
def insert_select(t: Tables):
    """A declared JSON table, read by SQL and inserted into a catalog table in two statements."""
    root = shared_dir(t.spark, "insert")
    lines = t.events.select(F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("page_id"),
        F.col("event_type").alias("status"))).alias("value"))
    feed = declare(t.spark, "input_feed", "user_id BIGINT, page_id BIGINT, status STRING", lines)
    name = "output_feed_" + root[-8:]
    create_table(feed, name, f"{root}/table")
    for condition in ("status = 'error'", "status IS DISTINCT FROM 'error'"):
        insert_into(t.spark.sql(f"SELECT * FROM input_feed WHERE {condition}"), name, 4)
    stored = t.spark.table(name)
    return stored.groupBy("status").agg(n_rows(), F.max("page_id").alias("last_id"))


@query("""SELECT h AS hour, count(event_id) AS n FROM
            (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events),
                                           (SELECT max(ts) FROM events), INTERVAL 1 HOUR)) AS h)
          LEFT JOIN events ON date_trunc('hour', ts) = h GROUP BY h""")
def hour_calendar(t: Tables):
    """Every hour of the span of the events, also those without any."""
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).alias("value")
    counted = t.events.select(hour).groupBy("value").agg(n_rows())
    first, last = t.events.select(hour).agg(F.min("value"), F.max("value")).first()
    return (sequence(t.spark, first, last).join(counted, "value", "left")
            .select(F.timestamp_seconds(F.col("value") * 3600).cast("timestamp_ntz").alias("hour"),
                    F.coalesce("n", F.lit(0)).alias("n")))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def rewritten_batch(t: Tables):
    """A batch that is written again replaces itself."""
    root = shared_dir(t.spark, "batches")
    deliver = write_once(root)
    low, high = t.events.where("value <= 20"), t.events.where("value > 20")
    deliver(low, 0)
    deliver(high.where("event_type = 'view'"), 1)      # a first try that broke off
    deliver(high, 1)
    return read_batches(t.spark, root).groupBy("event_type").agg(n_rows())
