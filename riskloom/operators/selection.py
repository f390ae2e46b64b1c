"""Rules over run and version tables: winner, gate and promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import GATE_AVG_PRECISION, GATE_PRECISION_AT_80RECALL, SELECTION_KEYS


def _selection_order(metric: str, algorithms: Sequence[str]) -> list[Column]:
    """Best first: the chosen metric, then validation AP, then the order of configuration."""
    place = F.array_position(F.array(*[F.lit(a) for a in algorithms]), F.col("algorithm"))
    key = SELECTION_KEYS[metric]
    return [
        F.col(f"metrics.{key}").desc_nulls_last(),
        F.col("metrics.val_avg_precision").desc_nulls_last(),
        place.asc(),
        F.col("run_id").asc(),
    ]


def leaderboard(runs: DataFrame, columns: Sequence[str], metric: str, algorithms: Sequence[str]) -> DataFrame:
    """Runs with the given metrics to four decimals, best first."""
    shown = [F.round(F.col(f"metrics.{c}"), 4).alias(c) for c in columns]
    return runs.orderBy(*_selection_order(metric, algorithms)).select("run_id", "algorithm", *shown)


def select_winner(runs: DataFrame, metric: str, algorithms: Sequence[str]) -> DataFrame:
    """The best run, one row."""
    return runs.orderBy(*_selection_order(metric, algorithms)).limit(1)


def quality_gate(
    runs: DataFrame,
    avg_precision: float = GATE_AVG_PRECISION,
    precision_at_80recall: float = GATE_PRECISION_AT_80RECALL,
) -> DataFrame:
    """Whether each run is good enough to register; a missing metric counts as 0.0."""

    def metric(name: str) -> Column:
        return F.coalesce(F.try_element_at("metrics", F.lit(name)), F.lit(0.0))

    ap, p80 = metric("avg_precision"), metric("precision_at_80recall")
    return runs.select(
        "run_id",
        ap.alias("avg_precision"),
        metric("roc_auc").alias("roc_auc"),
        p80.alias("precision_at_80recall"),
        ((ap >= avg_precision) & (p80 >= precision_at_80recall)).alias("eval_passed"),
    )


def champion_history(versions: DataFrame, model: str = "model", version: str = "version", metric: str = "metric") -> DataFrame:
    """Replay registration: each version becomes champion if no champion so far is better.

    A later version wins a tie, and the first always wins. A version without the metric is an
    error, as its run did not finish.
    """
    checked = F.when(
        F.col(metric).isNull(), F.raise_error(F.concat(F.lit("no metric for version "), F.col(version).cast("string")))
    ).otherwise(F.col(metric))
    # One row a training run: a model's versions fit one task by nature.
    earlier = Window.partitionBy(model).orderBy(version).rowsBetween(Window.unboundedPreceding, -1)
    rows = versions.withColumn(metric, checked)
    runs = rows.withColumn("_before", F.max(metric).over(earlier))
    before = F.coalesce(F.col("_before"), F.lit(-1.0))
    return runs.select(
        *versions.columns,
        before.alias("champion_metric"),
        (F.col(metric) >= before).alias("promoted"),
    )


def current_aliases(
    history: DataFrame, model: str = "model", version: str = "version", metric: str = "metric"
) -> DataFrame:
    """Where the two aliases point after the replay: last promoted and last registered version."""
    last = history.groupBy(model).agg(
        F.max(F.when(F.col("promoted"), F.struct(F.col(version).alias("v"), F.col(metric).alias("m")))).alias("_best"),
        F.max(version).alias("challenger"),
    )
    return last.select(
        model, F.col("_best.v").alias("champion"), F.col("_best.m").alias("champion_metric"), "challenger"
    )


def cross_environment(source: DataFrame, target: DataFrame, model: str = "model") -> DataFrame:
    """Whether each source champion becomes champion of the target environment.

    A source without the metric never does. A target that is absent, has no metric or has 0.0
    counts as -1. The copy gets the alias 'champion' or else 'challenger'.
    """
    pairs = source.select(model, F.col("metric").alias("source_metric")).join(
        target.select(model, F.col("metric").alias("target_metric")), model, "left"
    )
    bar = F.coalesce(F.nullif(F.col("target_metric"), F.lit(0.0)), F.lit(-1.0))
    promoted = F.coalesce(F.col("source_metric") >= bar, F.lit(False))
    return pairs.select(
        model,
        "source_metric",
        "target_metric",
        promoted.alias("promoted"),
        F.when(promoted, "champion").otherwise("challenger").alias("alias"),
    )
