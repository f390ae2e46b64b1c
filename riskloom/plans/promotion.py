"""Registration and promotion over a version table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.selection import champion_history, cross_environment, current_aliases
from riskloom.session import stored
from riskloom.sources.tables import append_by_name

SCHEMA = "model string, version int, run_id string, metric double"


def register(spark: SparkSession, table: str, model: str, run_id: str, metric: float) -> bool:
    """Append the next version of ``model``; true if it becomes champion."""
    if metric is None:
        raise ValueError(f"run {run_id} has no metric")
    version, best = 1, None
    if spark.catalog.tableExists(table):
        # The champion is the best version so far, so one row tells both.
        known = spark.table(table).filter(F.col("model") == model).agg(F.max("version"), F.max("metric")).first()
        version, best = (known[0] or 0) + 1, known[1]
    append_by_name(spark.createDataFrame([(model, version, run_id, float(metric))], SCHEMA), table)
    return best is None or float(metric) >= best


def aliases(spark: SparkSession, table: str) -> DataFrame:
    """Champion and challenger of every model in the version table."""
    return current_aliases(champion_history(spark.table(table)))


def promote_across(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy every source champion into the target's version table; which of them become champions there.

    A copy is the target's next version, under the run that the source knows. The replay of the target then moves
    the alias by the same rule. One row a model, so the result is small; it is stored before the target is written.
    """

    def champions(table: str) -> DataFrame:
        return aliases(spark, table).select("model", F.col("champion_metric").alias("metric"))

    exists = spark.catalog.tableExists(target)
    there = champions(target) if exists else spark.createDataFrame([], "model string, metric double")
    decided = stored(cross_environment(champions(source), there))
    best = aliases(spark, source).select("model", F.col("champion").alias("source_version"))
    runs = spark.table(source).select("model", F.col("version").alias("source_version"), "run_id")
    copies = decided.filter(F.col("source_metric").isNotNull()).join(best, "model").join(runs, ["model", "source_version"])
    last = spark.table(target).groupBy("model").agg(F.max("version").alias("last")) if exists else None
    copies = copies.join(last, "model", "left") if exists else copies.withColumn("last", F.lit(None).cast("int"))
    version = (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("version")
    append_by_name(stored(copies.select("model", version, "run_id", F.col("source_metric").alias("metric"))), target)
    return decided
