"""Search, refit, threshold, metrics and winner over stored feature tables.

Only settings, fitted models and a few metric rows are on the driver. The tables are never
fetched: every step is a Spark job over them.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import PARAM_GRIDS, TXN, TrainingSettings
from riskloom.operators.curve import alert_budget, operating_points, pr_curve, run_metrics
from riskloom.operators.features import check_features_present, feature_columns
from riskloom.operators.models import (
    SearchResult,
    draw_settings,
    fit,
    known_algorithms,
    search,
    with_threshold,
)
from riskloom.operators.sampling import exact_stratified_holdout, search_sample, stratified_folds
from riskloom.operators.scoring import score
from riskloom.operators.selection import quality_gate, select_winner
from riskloom.session import stored
from riskloom.sources.tables import export_csv


@dataclass(frozen=True)
class TrainingOutcome:
    runs: DataFrame
    operating_points: DataFrame
    models: dict[str, PipelineModel]
    searches: dict[str, SearchResult]
    winner: str
    winner_run_id: str
    threshold: float
    eval_passed: bool


def _scores(model: PipelineModel, rows: DataFrame, algorithm: str, label: str) -> DataFrame:
    scored = score(rows, model).select(label, F.col("probability").alias("score"))
    return scored.withColumn("algorithm", F.lit(algorithm))


def train_and_select(
    train: DataFrame,
    test: DataFrame,
    grids: Mapping[str, Mapping] = PARAM_GRIDS,
    settings: TrainingSettings | None = None,
    key: str = "txn_id",
    label: str = TXN.label,
    report_folder: str | None = None,
) -> TrainingOutcome:
    """Train every configured algorithm and choose the best on the validation rows.

    ``train`` and ``test`` are stored tables with a unique ``key``. The test rows serve for the
    reported metrics only. ``report_folder`` gets the operating points as CSV.
    """
    settings = settings or TrainingSettings()
    algorithms, unknown = known_algorithms(grids)
    if unknown:
        warnings.warn(f"ignoring unknown algorithms: {unknown}", stacklevel=2)
    features = feature_columns(train, also_not=[key, "split"])
    check_features_present(features, test)

    split = stored(exact_stratified_holdout(train, settings.val_fraction, label, key, settings.seed), "split")
    fit_rows = split.filter(F.col("split") == "fit")
    val_rows = split.filter(F.col("split") == "val")
    sample = search_sample(fit_rows, settings.search_neg_per_pos, label, key, settings.seed)
    # Every algorithm searches the same sample, so it is kept.
    sample = stored(stratified_folds(sample, settings.search_folds, label, key, settings.seed))

    models, searches, val_scores, test_scores = {}, {}, [], []
    for name in algorithms:
        tried = draw_settings(grids[name], settings.search_n_iter, settings.seed)
        searches[name] = search(
            sample, name, tried, settings.search_folds, features, label, settings.seed
        )
        models[name] = fit(fit_rows, name, searches[name].params, features, label, settings.seed)
        val_scores.append(_scores(models[name], val_rows, name, label))
        test_scores.append(_scores(models[name], test, name, label))

    # The metrics read the scores several times; scoring with large forests is the costly part.
    validation = stored(reduce(DataFrame.unionByName, val_scores))
    tested = stored(reduce(DataFrame.unionByName, test_scores))
    spark = train.sparkSession
    cv = spark.createDataFrame(
        [(name, s.score) for name, s in searches.items()], "algorithm string, cv_best_score_on_sample double"
    )
    metrics = run_metrics(validation, tested, "score", settings.target_recall, cv, label=label)
    about = spark.createDataFrame(
        [(name, uuid4().hex, {k: str(v) for k, v in s.params.items()}) for name, s in searches.items()],
        "algorithm string, run_id string, params map<string,string>",
    )
    runs = stored(about.join(F.broadcast(metrics), "algorithm").select("run_id", "algorithm", "params", "metrics"))
    points = operating_points(pr_curve(tested, "score", label, ["algorithm"]), by=["algorithm"])
    if report_folder:
        points = stored(points)
        export_csv(points, report_folder)

    # One row per algorithm from here on.
    found = {r["algorithm"]: r for r in runs.collect()}
    for name in algorithms:
        if "decision_threshold" not in found[name]["metrics"]:
            raise ValueError(f"{name}: a recall of {settings.target_recall} is out of reach on the validation rows")
    over = alert_budget(
        runs.select("algorithm", F.col("metrics.alerts_per_fraud_at_threshold").alias("alerts_per_fraud")),
        settings.max_alerts_per_fraud,
    ).filter("over_budget")
    for row in over.collect():
        warnings.warn(
            f"{row['algorithm']}: {row['alerts_per_fraud']:.0f} alerts per fraud at the chosen threshold, "
            f"above {settings.max_alerts_per_fraud:.0f}",
            stacklevel=2,
        )
    best = select_winner(runs, settings.selection_metric, algorithms)
    winner = best.first()
    passed = quality_gate(best).first()["eval_passed"]
    return TrainingOutcome(
        runs=runs,
        operating_points=points,
        models=models,
        searches=searches,
        winner=winner["algorithm"],
        winner_run_id=winner["run_id"],
        threshold=winner["metrics"]["decision_threshold"],
        eval_passed=passed,
    )


def served_model(outcome: TrainingOutcome, thresholded: bool = True) -> PipelineModel:
    """The winner as one savable model, deciding at its tuned threshold unless told otherwise."""
    model = outcome.models[outcome.winner]
    return with_threshold(model, outcome.threshold) if thresholded else model
