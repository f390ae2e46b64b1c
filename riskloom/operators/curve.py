"""Exact threshold-curve metrics of a score against a 0/1 label.

The curve has one point per distinct score: rows with that score or a higher one are flagged, so
ties count together. Everything below is an aggregate over that curve. Each operator takes ``by``
columns and then gives one answer per group, for example per model or per day.

Without positives in a group, average precision and ROC AUC are null, precision at recall is
0.0, and no threshold exists. Rows without a label or a score are not on the curve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasProbabilityCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import OPERATING_RECALLS, TXN
from riskloom.functions.columns import ratio
from riskloom.operators.running import running_totals


def pr_curve(
    df: DataFrame, score: str, label: str = TXN.label, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Precision and recall at every distinct score, with the counts behind them."""
    scored = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = scored.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    runs = running_totals(points, "threshold", sums=["pos", "n"], by=by, descending=True, unique=True, buckets=buckets)
    return runs.select(
        *by,
        "threshold",
        "pos",
        "n",
        F.col("run_pos").alias("tp"),
        F.col("run_n").alias("flagged"),
        F.col("all_pos").alias("positives"),
        F.col("all_n").alias("rows"),
        (F.col("run_pos") / F.col("run_n")).alias("precision"),
        F.try_divide(F.col("run_pos"), F.col("all_pos")).alias("recall"),
    )


def _aggregate(curve: DataFrame, by: Sequence[str], *columns: Column) -> DataFrame:
    return curve.groupBy(*by).agg(*columns) if by else curve.agg(*columns)


def _average_precision() -> Column:
    return F.sum(F.try_divide(F.col("pos"), F.col("positives")) * F.col("precision"))


def _roc_auc() -> Column:
    negatives = F.col("n") - F.col("pos")
    caught = F.col("tp") - F.col("pos") + F.col("pos") / 2
    pairs = F.max(F.col("positives").cast("double") * (F.col("rows") - F.col("positives")))
    return F.try_divide(F.sum(negatives * caught), pairs)


def _best_precision(recall: float) -> Column:
    if recall <= 0:
        return F.lit(1.0)
    return F.coalesce(F.max(F.when(F.col("recall") >= recall, F.col("precision"))), F.lit(0.0))


def _point_at(recall: float) -> Column:
    """Of the points that reach the recall, the one that flags fewest rows."""
    point = F.struct("threshold", "precision", "recall")
    return F.max(F.when(F.col("recall") >= recall, point))


def average_precision(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Step-wise area: precision at each point times the recall gained there."""
    return _aggregate(curve, by, _average_precision().alias("average_precision"))


def roc_auc(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Chance that a positive outranks a negative; ties count half."""
    return _aggregate(curve, by, _roc_auc().alias("roc_auc"))


def precision_at_recall(curve: DataFrame, recall: float, by: Sequence[str] = ()) -> DataFrame:
    """The best precision among points with at least the given recall."""
    return _aggregate(curve, by, _best_precision(recall).alias("precision_at_recall"))


def choose_threshold(curve: DataFrame, recall: float, by: Sequence[str] = ()) -> DataFrame:
    """The highest threshold that reaches the recall, with its own precision and recall.

    A group in which no threshold does has no row.
    """
    best = _aggregate(curve, by, _point_at(recall).alias("_at")).filter(F.col("_at").isNotNull())
    return best.select(*by, "_at.threshold", "_at.precision", "_at.recall")


def operating_points(
    curve: DataFrame, recalls: Sequence[float] = OPERATING_RECALLS, by: Sequence[str] = ()
) -> DataFrame:
    """``choose_threshold`` at several recalls, with the alerts raised per fraud found."""
    points = F.array(*[F.struct(F.lit(r).alias("target_recall"), _point_at(r).alias("at")) for r in recalls])
    rows = _aggregate(curve, by, points.alias("_points")).select(*by, F.explode("_points").alias("_p"))
    rows = rows.filter(F.col("_p.at").isNotNull())
    return rows.select(
        *by,
        "_p.target_recall",
        "_p.at.threshold",
        "_p.at.precision",
        (1 / F.greatest(F.col("_p.at.precision"), F.lit(1e-12))).alias("alerts_per_fraud"),
    )


def curve_summary(
    curve: DataFrame,
    target_recall: float,
    recalls: Sequence[float] = OPERATING_RECALLS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Every curve metric of a run in one pass over the curve."""
    return _aggregate(curve, by, *_summary(recalls), _point_at(target_recall).alias("chosen"))


def _summary(recalls: Sequence[float]) -> list[Column]:
    return [
        _average_precision().alias("average_precision"),
        _roc_auc().alias("roc_auc"),
        _best_precision(0.80).alias("precision_at_80recall"),
        *[_point_at(r).getField("precision").alias(f"precision_at_recall_{round(r * 100)}") for r in recalls],
    ]


def confusion_at(
    df: DataFrame,
    score: str,
    threshold: float | Column,
    label: str = TXN.label,
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and ratios when scores at or above ``threshold`` are flagged."""
    flagged = F.col(score) >= threshold
    return confusion_of(df.withColumn("_flag", flagged.cast("int")), "_flag", label, by)


def confusion_of(df: DataFrame, prediction: str, label: str = TXN.label, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and ratios of 0/1 predictions; a ratio over nothing is 0.0."""
    hit, fraud = F.col(prediction) == 1, F.col(label) == 1
    counts = _aggregate(
        df,
        by,
        F.count_if(hit & fraud).alias("tp"),
        F.count_if(hit & ~fraud).alias("fp"),
        F.count_if(~hit & fraud).alias("fn"),
        F.count_if(~hit & ~fraud).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp + fp, tp).alias("alerts_per_fraud"),
        ratio(tp + fp, tp + fp + fn + tn).alias("flagged_rate"),
    )


def alert_budget(confusion: DataFrame, max_alerts_per_fraud: float = 100.0) -> DataFrame:
    """Add whether the threshold raises more alerts per fraud than allowed."""
    return confusion.withColumn("over_budget", F.col("alerts_per_fraud") > max_alerts_per_fraud)


def run_metrics(
    validation: DataFrame,
    test: DataFrame,
    score: str,
    target_recall: float,
    cv_scores: DataFrame | None = None,
    by: Sequence[str] = ("algorithm",),
    label: str = TXN.label,
) -> DataFrame:
    """The metric record of each run, as one map per ``by`` group.

    The threshold is chosen on ``validation`` and applied to ``test``. ``cv_scores`` has
    ``cv_best_score_on_sample`` per group. ``by`` identifies models, of which there are few.
    """
    by = list(by)
    val = curve_summary(pr_curve(validation, score, label, by), target_recall, (), by).select(
        *by,
        F.col("average_precision").alias("val_avg_precision"),
        F.col("precision_at_80recall").alias("val_precision_at_80recall"),
        F.col("chosen.precision").alias("val_precision_at_target_recall"),
        F.col("chosen.recall").alias("val_recall_at_threshold"),
        F.col("chosen.threshold").alias("decision_threshold"),
    )
    # One row per model. The test curve holds the confusion counts of every threshold, so the
    # scores themselves are not read again.
    chosen = F.broadcast(val.select(*by, "decision_threshold"))
    test_curve = pr_curve(test, score, label, by).join(chosen, by)
    flagged = F.col("threshold") >= F.col("decision_threshold")
    at_threshold = test_curve.groupBy(*by).agg(
        *_summary(OPERATING_RECALLS),
        F.coalesce(F.max(F.when(flagged, F.col("tp"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.max(F.when(flagged, F.col("flagged"))), F.lit(0)).alias("_flagged"),
        F.max("positives").alias("_positives"),
        F.max("rows").alias("_rows"),
    )
    tp, alerts = F.col("_tp"), F.col("_flagged")
    tested = at_threshold.select(
        *[c for c in at_threshold.columns if not c.startswith("_")],
        ratio(tp, F.col("_positives")).alias("recall_at_threshold"),
        ratio(tp, alerts).alias("precision_at_threshold"),
        ratio(alerts, tp).alias("alerts_per_fraud_at_threshold"),
        ratio(alerts, F.col("_rows")).alias("flagged_rate_at_threshold"),
        tp.cast("double").alias("tp_at_threshold"),
        (alerts - tp).cast("double").alias("fp_at_threshold"),
        (F.col("_positives") - tp).cast("double").alias("fn_at_threshold"),
    )
    record = val.join(tested, by).withColumnRenamed("average_precision", "avg_precision")
    if cv_scores is not None:
        record = record.join(cv_scores, by, "left")
    names = [c for c in record.columns if c not in by]
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*[F.col(c) for c in names]))
    # A metric that does not exist is absent from the record.
    return record.select(*by, F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("metrics"))


class StepAveragePrecision(Evaluator, HasLabelCol, HasProbabilityCol):
    """Average precision as a Spark ML evaluator.

    Spark's own ``areaUnderPR`` joins the points by straight lines, which is a different number.
    """

    @keyword_only
    def __init__(self, *, labelCol: str = TXN.label, probabilityCol: str = "probability"):
        super().__init__()
        self._set(labelCol=labelCol, probabilityCol=probabilityCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        p = vector_to_array(F.col(self.getProbabilityCol()))[1]
        scored = dataset.select(F.col(self.getLabelCol()).alias("label"), p.alias("score"))
        found = average_precision(pr_curve(scored, "score", "label")).first()
        return float(found["average_precision"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True
