"""Shared session and folders. Scratch data goes to a fresh folder per test session."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from riskloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        8,
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.sql.catalogImplementation": "in-memory",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def rows(spark):
    """Build a frame from tuples and a schema string."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
