"""Every query with SQL gives the same rows in Spark and in DuckDB."""

import pytest
from compare import connect, difference
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from riskloom.catalog import load

# The document queries have their own tests.
QUERIES, SQL = load()
SLOW = {"cv_search_forest"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert difference(got, duck.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[0] == "event_id"
    assert frame.count() > 0
