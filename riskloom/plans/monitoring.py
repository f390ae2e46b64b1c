"""Logging of scored windows and the drift check over the log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import DRIFT_SAMPLE_ROWS, FEATURES
from riskloom.operators.drift import breaches, drift_verdict, ks_drift
from riskloom.operators.sampling import ordered_sample
from riskloom.operators.scoring import simulated_payload
from riskloom.operators.summaries import (
    SUMMARY_POINTS,
    at_window,
    bounded_breaches,
    ks_bounds,
    newest_windows,
    undecided,
    window_summaries,
)
from riskloom.session import stored
from riskloom.sources.tables import append_by_day, append_by_name, replace_partitions


def log_simulated_windows(
    table: DataFrame,
    model: PipelineModel,
    as_of: datetime,
    model_version: str,
    log: str,
    rows: int = DRIFT_SAMPLE_ROWS,
    key: str = "txn_id",
    by_day: bool = False,
) -> DataFrame:
    """Append a normal and a shifted window of scored rows to the inference log.

    ``model`` decides by itself, see ``served_model``. ``by_day`` keeps the log in a folder a day, of which a refresh
    reads the last ones only. Returns what was appended.
    """
    sample = stored(ordered_sample(table, rows, key))
    payload = stored(simulated_payload(sample, model.transform, as_of, model_version))
    (append_by_day if by_day else append_by_name)(payload, log)
    return payload


def unseen(log: DataFrame, drift: DataFrame, ts: str = "request_ts", width: str = "1 day") -> tuple[DataFrame, object]:
    """What of the log a refresh must read: from the window before the last one recorded on, which is
    taken again because it may have grown. Also that last window's start; null where nothing is recorded."""
    last = drift.agg(F.max("window.start")).first()[0]
    if last is None:
        return log, None
    # A null maximum is in no window, so there may be no row.
    before = log.filter(F.col(ts) < F.lit(last)).agg(F.max(ts).alias("ts")).select(F.window("ts", width)["start"]).first()
    return since(log, last if before is None else before[0], ts), last


def since(log: DataFrame, start: object, ts: str = "request_ts") -> DataFrame:
    """The log's rows from ``start`` on; of a log in a folder a day only the last folders are read."""
    rows = log.filter(F.col(ts) >= F.lit(start))
    if "request_date" in log.columns:
        # A day more, in case the days were cut in another time zone.
        rows = rows.filter(F.col("request_date") >= F.date_sub(F.to_date(F.lit(start)), 1))
    return rows


def refresh_drift(spark: SparkSession, log: str, drift: str, features: Sequence[str] = FEATURES) -> bool:
    """Bring the drift table up to date with the log; true when the newest window calls for retraining.

    Reads new windows, the last one recorded and its predecessor. The table has a partition a window, ``window_date``;
    those of older windows are not written again. Windows are days.
    """
    rows = spark.table(log)
    if spark.catalog.tableExists(drift):
        rows, _ = unseen(rows, spark.table(drift))
    fresh = ks_drift(rows, features).withColumn("window_date", F.to_date("window.start"))
    # Stored first: a table cannot be replaced while it is read.
    replace_partitions(stored(fresh), drift, "window_date")
    return drift_verdict(spark.table(drift)).first()["retrain"]


@dataclass(frozen=True)
class SummaryVerdict:
    """Columns beyond the limits in the newest window, and those of them and others that took the rows to decide."""

    breached: list[str]
    compared_exactly: list[str]

    @property
    def retrain(self) -> bool:
        return bool(self.breached)


def refresh_summaries(
    spark: SparkSession, log: str, summaries: str, features: Sequence[str] = FEATURES, points: int = SUMMARY_POINTS
) -> SummaryVerdict:
    """Bring a table of window summaries up to date with the log and judge its newest window, as ``refresh_drift`` does.

    Reads new windows and the last one summarised, which may have grown; the window before that is compared by its
    summary. Only where the bounds of a column lie on both sides of a limit are the two windows' rows of that column
    compared exactly, so the verdict is always that of all rows. Windows are days, one partition ``window_date`` each;
    rows that arrive for older windows than the last are not seen. With fewer than two windows nothing is beyond a limit.
    """
    rows = spark.table(log)
    if spark.catalog.tableExists(summaries):
        last = newest_windows(spark.table(summaries), 1)
        rows = since(rows, last[0]) if last else rows
    fresh = window_summaries(rows, features, points=points).withColumn("window_date", F.to_date("window.start"))
    # Stored first: the table is written while nothing reads it, and the summaries are computed once.
    replace_partitions(stored(fresh), summaries, "window_date")
    table = spark.table(summaries)
    starts = newest_windows(table)
    if len(starts) < 2:
        return SummaryVerdict([], [])
    now, before = (at_window(table, start).filter(F.col("column_name").isin(*features)) for start in starts)
    decided = stored(bounded_breaches(ks_bounds(now, before)))
    open_columns = undecided(decided)
    found = [r[0] for r in decided.filter("breach").select("column_name").collect()]
    if open_columns:
        exact = ks_drift(since(spark.table(log), starts[1]), open_columns)
        found += [r[0] for r in breaches(exact).select("column_name").collect()]
    return SummaryVerdict(sorted(found), sorted(open_columns))
