"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(root: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), _bag(df.columns, df.collect())


def sql_bag(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), _bag(columns, cur.fetchall())


def assert_same(df, con, sql):
    spark_columns, ours = spark_bag(df)
    sql_columns, theirs = sql_bag(con, sql)
    assert spark_columns == sql_columns
    assert ours == theirs, (f"{sum(ours.values())} rows against {sum(theirs.values())}; only here "
                            f"{list((ours - theirs).items())[:3]}; only there "
                            f"{list((theirs - ours).items())[:3]}")
    return sum(ours.values())
