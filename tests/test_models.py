import random
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskloom.config import FEATURES, TrainingSettings
from riskloom.operators import models, scoring
from riskloom.operators.curve import StepAveragePrecision
from riskloom.plans import feature_tables, monitoring, training
from riskloom.sources import tables

SETTINGS = {
    "logistic_regression": {"max_iter": 50, "C": 1.0, "class_weight": "balanced"},
    "random_forest": {"n_estimators": 5, "max_depth": None, "min_samples_leaf": 1, "class_weight": {0: 1, 1: 20}},
    "hist_gradient_boosting": {
        "max_iter": 4, "learning_rate": 0.1, "max_depth": 3, "min_samples_leaf": 5, "class_weight": None,
    },
}


@pytest.fixture(scope="module")
def separable(spark):
    draw = random.Random(0)
    data = []
    for i in range(600):
        label = int(i % 10 == 0)
        data.append((i, label, draw.gauss(4 if label else 0, 1), draw.random()))
    return spark.createDataFrame(data, "txn_id long, isFraud int, a double, b double").cache()


@pytest.mark.parametrize("algorithm", sorted(SETTINGS))
def test_fit_finds_the_signal(separable, algorithm):
    model = models.fit(separable, algorithm, SETTINGS[algorithm], ["a", "b"])
    scored = scoring.score(separable, model, 0.5)
    assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0, 1}
    low, high = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= low <= high <= 1.0
    measure = StepAveragePrecision()
    assert measure.evaluate(model.transform(separable)) > 0.8
    assert measure.isLargerBetter()


def test_scoring_stays_in_the_jvm(separable):
    model = models.fit(separable, "logistic_regression", SETTINGS["logistic_regression"], ["a", "b"])
    plan = scoring.score(separable, model, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_threshold_is_inclusive_and_survives_saving(separable, tmp_path):
    model = models.fit(separable, "logistic_regression", SETTINGS["logistic_regression"], ["a", "b"])
    edge = scoring.score(separable, model).agg(F.max("probability")).first()[0]
    decided = models.with_threshold(model, edge)
    assert decided.transform(separable).filter("prediction = 1").count() >= 1
    decided.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[-1].getThreshold() == edge
    assert again.transform(separable).filter("prediction = 1").count() >= 1


def test_udf_gets_features_in_order(separable):
    def load():
        return lambda frame: (frame["a"] - 100 * frame["b"] > 0).astype("int32")

    got = separable.withColumn("p", scoring.scoring_udf(load, ["a", "b"]))
    want = separable.withColumn("p", (F.col("a") - 100 * F.col("b") > 0).cast("int"))
    assert got.exceptAll(want).count() == 0


def test_class_weights(separable):
    got = {r["isFraud"]: r["weight"] for r in models.class_weights(separable, "balanced").collect()}
    assert got == pytest.approx({0: 600 / (2 * 540), 1: 600 / (2 * 60)})
    with pytest.raises(ValueError):
        models.class_weights(separable, "odd")


def test_search_prefers_the_useful_setting(separable):
    folded = separable.withColumn("fold", (F.col("txn_id") % 3).cast("int"))
    settings = [{"max_iter": 50, "C": c, "class_weight": None} for c in (1e-9, 1.0)]
    found = models.search(folded, "logistic_regression", settings, features=["a", "b"])
    assert found.score == max(s for _, s in found.tried)
    assert len(found.tried) == 2


def test_whole_chain(spark):
    """Bronze table to feature tables, training, served model, log and drift verdict."""
    raw = spark.range(4000).select(
        (F.col("id") % 200 + 1).cast("int").alias("step"),
        F.when(F.col("id") % 4 == 0, "TRANSFER").when(F.col("id") % 4 == 1, "CASH_OUT").otherwise("PAYMENT").alias("type"),
        (F.col("id") * 37 % 1000 / 10).alias("amount"),
        F.concat(F.lit("C"), (F.col("id") % 97).cast("string")).alias("nameOrig"),
        F.concat(F.lit("M"), (F.col("id") % 31).cast("string")).alias("nameDest"),
    )
    raw = raw.withColumn("isFraud", ((F.col("type") == "TRANSFER") & (F.col("amount") > 80)).cast("int"))
    from riskloom.operators.ingest import stamp

    tables.merge_into_table(stamp(raw, "b1"), "bronze_chain")
    written = feature_tables.build_feature_tables(spark, "bronze_chain", "chain_train", "chain_test")
    checked = {r["table_name"]: r["row_count"] for r in feature_tables.report(written).collect()}
    assert sum(checked.values()) == 4000

    grids = {
        "logistic_regression": {"max_iter": [30], "C": [1.0], "class_weight": [None]},
        "random_forest": {
            "n_estimators": [5], "max_depth": [5], "min_samples_leaf": [1], "class_weight": ["balanced_subsample"],
        },
        "unheard_of": {},
    }
    with pytest.warns(UserWarning, match="unheard_of"):
        out = training.train_and_select(
            written["chain_train"], written["chain_test"], grids, TrainingSettings(search_folds=2)
        )
    assert out.winner == "random_forest"
    assert out.eval_passed
    record = {r["algorithm"]: r["metrics"] for r in out.runs.collect()}[out.winner]
    assert len(record) == 21
    assert 0.0 < record["decision_threshold"] <= 1.0
    assert out.operating_points.filter("algorithm = 'random_forest'").count() == 5

    model = training.served_model(out)
    as_of = datetime(2024, 5, 2, 12)
    monitoring.log_simulated_windows(written["chain_train"], model, as_of, "1", "chain_log", rows=500)
    assert spark.table("chain_log").columns == [*FEATURES, "isFraud", "prediction", "request_ts", "model_version"]
    assert spark.table("chain_log").count() == 1000
    assert monitoring.refresh_drift(spark, "chain_log", "chain_drift")


def test_a_fit_gets_the_checked_weights(separable, monkeypatch):
    seen = []
    monkeypatch.setitem(models.TOGETHER, "random_forest", lambda rows, settings, *rest: seen.extend(settings) or [])
    params = {**SETTINGS["random_forest"], "class_weight": "balanced"}
    models.fit_assembled(models.assembled(separable, ["a", "b"]), "random_forest", params)
    assert seen[0][1] == {r["isFraud"]: r["weight"] for r in models.class_weights(separable, "balanced").collect()}
    with pytest.raises(ValueError, match="odd"):
        models.fit_assembled(models.assembled(separable, ["a", "b"]), "random_forest", {**params, "class_weight": "odd"})


@pytest.mark.parametrize("algorithm", ["logistic_regression", "hist_gradient_boosting"])
def test_a_common_fit_gets_the_checked_weights(separable, monkeypatch, algorithm):
    seen = []
    monkeypatch.setitem(models.TOGETHER, algorithm, lambda rows, settings, label, seed: seen.extend(settings) or [])
    params = {**SETTINGS[algorithm], "class_weight": "balanced"}
    models.fit_assembled(models.assembled(separable, ["a", "b"]), algorithm, params)
    ((_, weights, without),) = seen
    assert weights == {r["isFraud"]: r["weight"] for r in models.class_weights(separable, "balanced").collect()}
    assert without is None


def test_search_refuses_a_fold_without_positives(separable):
    folded = separable.withColumn("fold", F.when(F.col("isFraud") == 1, 0).otherwise((F.col("txn_id") % 3).cast("int")))
    with pytest.raises(ValueError, match="without a positive"):
        models.search(folded, "logistic_regression", [{"max_iter": 5, "C": 1.0, "class_weight": None}], features=["a", "b"])


def test_rebuilt_tables_split_alike(spark):
    from riskloom.operators.ingest import stamp
    from riskloom.operators.sampling import exact_stratified_holdout

    raw = spark.range(900).select(
        (F.col("id") % 50 + 1).cast("int").alias("step"), F.lit("TRANSFER").alias("type"), (F.col("id") % 300).cast("double").alias("amount"),
        F.concat(F.lit("C"), (F.col("id") % 90).cast("string")).alias("nameOrig"), F.lit("M1").alias("nameDest"),
        (F.col("id") % 9 == 0).cast("int").alias("isFraud"),
    )
    found = []
    for parts in (3, 8):
        tables.overwrite_table(stamp(raw, "b1").repartition(parts), f"bronze_again_{parts}")
        written = feature_tables.build_feature_tables(spark, f"bronze_again_{parts}", f"again_train_{parts}", f"again_test_{parts}")
        train = written[f"again_train_{parts}"]
        split = exact_stratified_holdout(train, 0.12, key="txn_id").filter("split = 'val'")
        found.append(sorted(tuple(r) for r in split.drop("split").collect()))
        assert train.select("txn_id").distinct().count() == train.count()
    assert found[0] == found[1] and found[0]


def test_a_refresh_reads_new_windows_and_one_before(spark):
    days = spark.range(4000).select((F.col("id") % 100 / 7).alias("log_amount"), F.expr("timestamp'2024-01-01 06:00:00' + make_interval(0, 0, 0, int(id % 4))").alias("request_ts"))
    tables.overwrite_table(days.filter("request_ts < '2024-01-04'"), "refresh_log")
    monitoring.refresh_drift(spark, "refresh_log", "refresh_drift", ["log_amount"])
    tables.append_by_name(days.filter("request_ts >= '2024-01-04'"), "refresh_log")
    rows, last = monitoring.unseen(spark.table("refresh_log"), spark.table("refresh_drift"))
    assert str(last)[:10] == "2024-01-03"
    assert sorted(str(r[0])[:10] for r in rows.select(F.to_date("request_ts")).distinct().collect()) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    monitoring.refresh_drift(spark, "refresh_log", "refresh_drift", ["log_amount"])
    from riskloom.operators.drift import ks_drift

    whole = ks_drift(spark.table("refresh_log"), ["log_amount"])
    assert spark.table("refresh_drift").select(whole.columns).exceptAll(whole).count() == 0
    assert spark.table("refresh_drift").count() == whole.count() == 6


def test_a_log_by_day_is_read_and_written_by_partition(spark):
    from riskloom.operators.drift import ks_drift

    rows = spark.range(6000).select((F.col("id") % 100 / 7).alias("log_amount"), F.expr("timestamp'2024-01-01 06:00:00' + make_interval(0, 0, 0, int(id % 6))").alias("request_ts"))
    tables.append_by_day(rows.filter("request_ts < '2024-01-05'"), "day_log")
    monitoring.refresh_drift(spark, "day_log", "day_drift", ["log_amount"])
    files = lambda: {r[0]: r[1] for r in spark.table("day_drift").select("_metadata.file_path", "window_date").distinct().collect()}
    before = files()
    tables.append_by_day(rows.filter("request_ts >= '2024-01-05'"), "day_log")
    seen, _ = monitoring.unseen(spark.table("day_log"), spark.table("day_drift"))
    assert "PartitionFilters: [isnotnull(request_date" in seen._jdf.queryExecution().executedPlan().toString()
    assert {str(r[0]) for r in seen.select("request_date").distinct().collect()} == {f"2024-01-0{d}" for d in (3, 4, 5, 6)}
    monitoring.refresh_drift(spark, "day_log", "day_drift", ["log_amount"])
    after = files()
    # The windows before the last one recorded keep their files.
    kept = {path for path, day in before.items() if str(day) < "2024-01-04"}
    assert kept and kept <= set(after) and not (set(before) - kept) & set(after)
    whole = ks_drift(spark.table("day_log"), ["log_amount"])
    assert spark.table("day_drift").select(whole.columns).exceptAll(whole).count() == 0
    assert spark.table("day_drift").count() == whole.count() == 10
