import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import curve

TOY = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.6, 1), (0.1, 0)]


@pytest.fixture()
def toy(rows):
    return rows(TOY, "score double, isFraud int")


def brute(pairs):
    """Points (threshold, tp, flagged) by looking at every pair for every threshold."""
    return [
        (t, sum(y for s, y in pairs if s >= t), sum(1 for s, _ in pairs if s >= t))
        for t in sorted({s for s, _ in pairs}, reverse=True)
    ]


def test_areas_with_a_tie(toy):
    points = curve.pr_curve(toy, "score")
    assert curve.average_precision(points).first()[0] == pytest.approx(0.755556, abs=1e-6)
    assert curve.roc_auc(points).first()[0] == pytest.approx(0.722222, abs=1e-6)


def test_threshold_and_best_precision(toy, rows):
    points = curve.pr_curve(toy, "score")
    assert tuple(curve.choose_threshold(points, 0.6).first()) == pytest.approx((0.7, 2 / 3, 2 / 3))
    assert curve.precision_at_recall(points, 0.6).first()[0] == pytest.approx(2 / 3)
    assert curve.precision_at_recall(points, 0.0).first()[0] == 1.0
    other = curve.pr_curve(rows([(0.9, 0), (0.8, 1), (0.7, 1)], "score double, isFraud int"), "score")
    assert curve.precision_at_recall(other, 0.5).first()[0] == pytest.approx(2 / 3)
    assert tuple(curve.choose_threshold(other, 0.5).first())[:2] == pytest.approx((0.8, 0.5))


def test_confusion(toy):
    got = curve.confusion_at(toy, "score", 0.7).first().asDict()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (2, 1, 1, 2)
    assert (got["alerts_per_fraud"], got["flagged_rate"]) == (1.5, 0.5)
    none = curve.confusion_at(toy, "score", 2.0).first().asDict()
    assert (none["precision"], none["recall"], none["alerts_per_fraud"]) == (0.0, 0.0, 0.0)
    assert curve.alert_budget(curve.confusion_at(toy, "score", 0.7), 1.0).first()["over_budget"]


def test_operating_points(toy):
    got = {r["target_recall"]: r["threshold"] for r in curve.operating_points(curve.pr_curve(toy, "score")).collect()}
    assert got == {0.5: 0.7, 0.6: 0.7, 0.7: 0.6, 0.8: 0.6, 0.9: 0.6}


def test_without_positives(rows):
    points = curve.pr_curve(rows([(0.5, 0), (0.2, 0)], "score double, isFraud int"), "score")
    assert curve.average_precision(points).first()[0] is None
    assert curve.roc_auc(points).first()[0] is None
    assert curve.precision_at_recall(points, 0.8).first()[0] == 0.0
    assert curve.choose_threshold(points, 0.6).count() == 0
    assert curve.operating_points(points).count() == 0


@pytest.mark.parametrize("buckets", [2, 5, 16, 64])
def test_curve_equals_brute_force(rows, buckets):
    draw = random.Random(buckets)
    pairs = [(float(draw.choice([draw.randrange(400), 7, -3])), int(draw.random() < 0.2)) for _ in range(700)]
    points = curve.pr_curve(rows(pairs, "score double, isFraud int"), "score", buckets=buckets)
    got = sorted(((r["threshold"], r["tp"], r["flagged"]) for r in points.collect()), reverse=True)
    assert got == brute(pairs)


def test_grouped_curve_with_null_group(rows):
    draw = random.Random(1)
    data = [(g, float(draw.randrange(50)), int(draw.random() < 0.3)) for g in ("a", "b", None) for _ in range(200)]
    points = curve.pr_curve(rows(data, "g string, score double, isFraud int"), "score", by=["g"])
    for group in ("a", "b", None):
        got = sorted(
            ((r["threshold"], r["tp"], r["flagged"]) for r in points.collect() if r["g"] == group), reverse=True
        )
        assert got == brute([(s, y) for g, s, y in data if g == group])


def test_areas_do_not_change_under_monotone_maps(toy):
    moved = toy.selectExpr("exp(3 * score) - 100 AS score", "isFraud")
    a, b = (curve.average_precision(curve.pr_curve(d, "score")).first()[0] for d in (toy, moved))
    assert a == pytest.approx(b)


def test_the_data_is_never_in_one_task(spark):
    from conftest import SMALL

    from riskloom.catalog.frames import txn

    points = curve.pr_curve(txn(spark, SMALL), "amount")
    root = points._jdf.queryExecution().executedPlan().initialPlan()

    def check(node, above_totals):
        """A single-partition exchange may only carry rows that were summed per bucket."""
        text = node.simpleString(1000)
        if "SinglePartition" in text:
            below = node.children().apply(0).simpleString(1000)
            assert "_bucket" in below or "partial_" in below, below
        children = node.children()
        for i in range(children.size()):
            check(children.apply(i), above_totals)

    check(root, False)


def test_running_totals_do_not_rely_on_reuse(spark):
    rows = spark.range(3000).select((F.col("id") * 7919 % 1009 / 10).alias("score"), (F.col("id") % 11 == 0).cast("int").alias("isFraud"))
    want = curve.pr_curve(rows, "score").collect()
    names = ("spark.sql.exchange.reuse", "spark.sql.execution.reuseSubquery")
    try:
        for name in names:
            spark.conf.set(name, "false")
        got = curve.pr_curve(rows, "score").collect()
    finally:
        for name in names:
            spark.conf.set(name, "true")
    assert sorted(got) == sorted(want) and len(got) > 500
