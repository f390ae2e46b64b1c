"""Every operator as a query over the given tables, next to the same computation in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where the computation has one."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from riskloom.catalog import (  # noqa: F401
        drift_checks,
        feature_checks,
        metric_checks,
        model_checks,
        quality_checks,
        sampling_checks,
        selection_checks,
    )

    return QUERIES, SQL
