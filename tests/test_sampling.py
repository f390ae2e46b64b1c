import pytest
from pyspark.sql import functions as F

from riskloom.operators import sampling


@pytest.fixture()
def labelled(spark):
    return spark.range(3000).select(
        F.col("id").alias("event_id"), (F.col("id") % 50 == 0).cast("int").alias("isFraud")
    )


def test_holdout_is_complete_and_repeatable(labelled):
    split = sampling.bernoulli_holdout(labelled, 0.12)
    again = sampling.bernoulli_holdout(labelled.repartition(11), 0.12)
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in again.collect()}
    assert split.filter("split = 'val'").count() == pytest.approx(360, abs=60)


def test_exact_holdout_sizes(labelled):
    split = sampling.exact_stratified_holdout(labelled, 0.12)
    counts = {(r["isFraud"], r["split"]): r["count"] for r in split.groupBy("isFraud", "split").count().collect()}
    assert sum(n for (_, s), n in counts.items() if s == "val") == 360
    assert counts[(1, "val")] in (7, 8)
    assert sum(counts.values()) == 3000


def test_search_sample_keeps_all_positives(labelled):
    sample = sampling.search_sample(labelled, 7)
    counts = {r["isFraud"]: r["count"] for r in sample.groupBy("isFraud").count().collect()}
    assert counts == {1: 60, 0: 420}
    assert sampling.search_sample(labelled, 4000).count() == 3000
    assert sampling.search_sample(labelled.filter("isFraud = 0"), 7).count() == 0


def test_ordered_sample(labelled):
    sample = sampling.ordered_sample(labelled, 100)
    assert sample.count() == 100
    assert sampling.ordered_sample(labelled, 10**6).count() == 3000
    smaller = {r[0] for r in sampling.ordered_sample(labelled, 40).collect()}
    assert smaller < {r[0] for r in sample.collect()}


def test_folds_are_balanced_and_independent_of_the_search_draw(labelled):
    folds = sampling.stratified_folds(sampling.search_sample(labelled, 7))
    counts = [r["count"] for r in folds.groupBy("fold").count().collect()]
    assert len(counts) == 3
    assert min(counts) > 120


def test_cutoffs_need_no_global_sort(labelled):
    plan = sampling.search_sample(labelled, 7)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan
    assert "rangepartitioning" not in plan


def test_split_summary(labelled):
    got = sampling.split_summary(labelled.withColumn("part", F.lit("all")), "part").first()
    assert (got["row_count"], got["fraud_count"]) == (3000, 60)


def test_classes_are_spread_evenly_over_folds_and_splits(labelled):
    folds = sampling.stratified_folds(labelled.repartition(13))
    counts = {(r["fold"], r["isFraud"]): r["count"] for r in folds.groupBy("fold", "isFraud").count().collect()}
    for c in (0, 1):
        own = [counts[f, c] for f in range(3)]
        assert max(own) - min(own) <= 1
    again = sampling.stratified_folds(labelled)
    assert folds.exceptAll(again.select(folds.columns)).count() == 0


def test_samples_need_no_product(spark, labelled):
    for sample in (sampling.ordered_sample(labelled, 50), sampling.search_sample(labelled, 7)):
        plan = sample._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
