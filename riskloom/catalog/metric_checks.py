"""Threshold-curve metrics, with the amount as stand-in score."""

from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import bake_off, features, runs, txn
from riskloom.catalog.sql import (
    AP,
    AUC,
    CONFUSION_RATIOS,
    FRAME,
    RUN_METRICS,
    RUNS,
    TXN,
    bake_off_of,
    best_precision,
    confusion_columns,
    curve_of,
)
from riskloom.operators import curve

CURVE = f"WITH {TXN}, {curve_of('txn', 'amount')}"


def _curve(spark, folder):
    return curve.pr_curve(txn(spark, folder), "amount")


def _rounded(df, *names):
    return df.withColumns({c: F.round(c, 9) for c in names})


@check(
    CURVE + 'SELECT threshold, pos, n, tp, flagged, round("precision", 9) AS "precision", round(recall, 9) AS recall FROM curve'
)
def pr_curve(spark, folder):
    points = _curve(spark, folder).select("threshold", "pos", "n", "tp", "flagged", "precision", "recall")
    return _rounded(points, "precision", "recall")


@check(CURVE + f"SELECT round({AP}, 9) AS average_precision FROM curve")
def average_precision(spark, folder):
    return _rounded(curve.average_precision(_curve(spark, folder)), "average_precision")


@check(CURVE + f"SELECT round({AUC}, 9) AS roc_auc FROM curve")
def roc_auc(spark, folder):
    return _rounded(curve.roc_auc(_curve(spark, folder)), "roc_auc")


@check(CURVE + f"SELECT round({best_precision(0.8)}, 9) AS precision_at_recall FROM curve")
def precision_at_recall(spark, folder):
    return _rounded(curve.precision_at_recall(_curve(spark, folder), 0.80), "precision_at_recall")


@check(
    CURVE + 'SELECT threshold, round("precision", 9) AS "precision", round(recall, 9) AS recall '
    "FROM curve WHERE recall >= 0.6 ORDER BY threshold DESC LIMIT 1"
)
def choose_threshold(spark, folder):
    return _rounded(curve.choose_threshold(_curve(spark, folder), 0.60), "precision", "recall")


@check(
    CURVE
    + """, targets AS (SELECT CAST(r AS DOUBLE) AS target_recall FROM (VALUES (0.5), (0.6), (0.7), (0.8), (0.9)) AS t(r))
SELECT target_recall, max(threshold) AS threshold, round(arg_max("precision", threshold), 9) AS "precision",
       round(1 / greatest(arg_max("precision", threshold), 1e-12), 9) AS alerts_per_fraud
FROM targets JOIN curve ON recall >= target_recall GROUP BY 1"""
)
def operating_points(spark, folder):
    return _rounded(curve.operating_points(_curve(spark, folder)), "precision", "alerts_per_fraud")


@check(
    f"WITH {FRAME}, {bake_off_of('frame', 'scored')}, {curve_of('scored', 'score', ['algorithm'])} "
    f"""SELECT algorithm, round({AP}, 9) AS average_precision, round({AUC}, 9) AS roc_auc FROM curve GROUP BY 1"""
)
def average_precision_by_algorithm(spark, folder):
    by = ["algorithm"]
    points = curve.pr_curve(bake_off(features(spark, folder)), "score", by=by)
    summary = curve.curve_summary(points, 0.60, by=by).select("algorithm", "average_precision", "roc_auc")
    return _rounded(summary, "average_precision", "roc_auc")


CONFUSION = f"WITH {TXN}, cm AS (SELECT {confusion_columns('amount >= 127.92')} FROM txn)"
RATIOS = ("precision", "recall", "alerts_per_fraud", "flagged_rate")


@check(CONFUSION + f"SELECT tp, fp, fn, tn, {CONFUSION_RATIOS} FROM cm")
def confusion_at_threshold(spark, folder):
    return _rounded(curve.confusion_at(txn(spark, folder), "amount", 127.92), *RATIOS)


@check(
    f"""WITH {TXN}, cm AS (SELECT "type", {confusion_columns('amount >= 127.92')} FROM txn GROUP BY 1),
r AS (SELECT "type", tp, fp, fn, tn, {CONFUSION_RATIOS} FROM cm)
SELECT "type", alerts_per_fraud, flagged_rate, alerts_per_fraud > 5 AS over_budget FROM r"""
)
def alert_budget(spark, folder):
    by_type = curve.confusion_at(txn(spark, folder), "amount", 127.92, by=["type"])
    checked = curve.alert_budget(by_type, 5.0).select("type", "alerts_per_fraud", "flagged_rate", "over_budget")
    return _rounded(checked, "alerts_per_fraud", "flagged_rate")


@check(
    f"WITH {RUNS} "
    + " UNION ALL ".join(
        f"SELECT run_id, algorithm, '{m}' AS metric, round(CAST({m} AS DOUBLE), 9) AS value FROM runs WHERE {m} IS NOT NULL"
        for m in RUN_METRICS
    )
)
def run_metrics(spark, folder):
    rows = runs(spark, folder).select("run_id", "algorithm", F.explode("metrics").alias("metric", "value"))
    return _rounded(rows, "value")
