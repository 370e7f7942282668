"""Every query with a SQL twin gives the same rows as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sparkloom.plans import catalogue
from tests.conftest import SMALL
from tests.oracle import assert_same, connect

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert assert_same(QUERIES[name](spark, SMALL), con, SQL[name]) > 0


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "total", "top_categories"]
    assert df.count() > 0
