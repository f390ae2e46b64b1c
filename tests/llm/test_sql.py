"""The queries that SQL can express give the same rows in Spark and in DuckDB."""

import pytest
from compare import connect, difference

from riskloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).execute(SQL[name]).df()) is None
