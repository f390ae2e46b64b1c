"""Model queries. A fit has no SQL form, so its query returns what must hold of it; scoring is compared
row by row, with models of fixed coefficients."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import stored_features
from riskloom.catalog.sql import FRAME, SAMPLE_DRAW, holdout_of
from riskloom.config import DRIFT_SAMPLE_ROWS, FEATURES, PARAM_GRIDS, TrainingSettings
from riskloom.operators import models, scoring
from riskloom.operators.curve import StepAveragePrecision
from riskloom.operators.sampling import exact_stratified_holdout, ordered_sample, search_sample, stratified_folds
from riskloom.session import stored

# A linear model, exact in binary.
COEFFICIENTS = {"log_amount": 0.5, "hour_of_day": -0.125, "type_TRANSFER": 1.5, "log_orig_txn_count": 0.25}
INTERCEPT, THRESHOLD = -2.0, 0.5
MARGIN = " + ".join(f'{w} * "{c}"' for c, w in COEFFICIENTS.items()) + f" + {INTERCEPT}"
#: Settings that the searches over trees try, as many as a training run; each is as many fits as there are folds.
TREE_SETTINGS = TrainingSettings().search_n_iter


def _parts(spark, folder):
    frame = stored_features(spark, folder)
    train = stored(exact_stratified_holdout(frame.filter(F.col("dataset") == "train"), 0.12), "split")
    return train.filter(F.col("split") == "fit").drop("split"), frame.filter(F.col("dataset") == "test")


def _first_setting(algorithm):
    return {name: values[0] for name, values in PARAM_GRIDS[algorithm].items()}


def _fit_and_check(spark, folder, algorithm):
    """Rows scored, and whether all probabilities are ones and rank better than chance."""
    fit, test = _parts(spark, folder)
    model = models.fit(fit, algorithm, _first_setting(algorithm))
    reached = StepAveragePrecision().evaluate(model.transform(test))
    facts = scoring.score(test, model).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.every(F.col("probability").between(0, 1)).alias("in_unit_interval"),
        F.avg("isFraud").alias("prevalence"),
    )
    better = F.lit(reached) >= F.col("prevalence")
    return facts.select("row_count", "in_unit_interval", better.alias("better_than_chance"))


FITTED = f"""WITH {FRAME} SELECT count(*) AS row_count, true AS in_unit_interval, true AS better_than_chance
FROM frame WHERE dataset = 'test'"""


@check(FITTED)
def fit_logistic(spark, folder):
    return _fit_and_check(spark, folder, "logistic_regression")


@check(FITTED)
def fit_forest(spark, folder):
    return _fit_and_check(spark, folder, "random_forest")


@check(FITTED)
def fit_boosting(spark, folder):
    return _fit_and_check(spark, folder, "hist_gradient_boosting")


def _search(spark, folder, algorithm, budget):
    """Settings tried, and whether the best one ranks better than chance on the held-out folds."""
    fit, _ = _parts(spark, folder)
    sample = stored(stratified_folds(search_sample(fit)))
    found = models.search(sample, algorithm, models.draw_settings(PARAM_GRIDS[algorithm], budget))
    chance = sample.agg(F.avg("isFraud")).first()[0]
    different = len({str(sorted(p.items(), key=str)) for p, _ in found.tried})
    row = (algorithm, different, bool(found.score > chance), found.score == max(s for _, s in found.tried))
    return spark.createDataFrame([row], "algorithm string, settings_tried int, better_than_chance boolean, best_wins boolean")


def _searched(algorithm, settings):
    return (
        f"SELECT '{algorithm}' AS algorithm, CAST({settings} AS INTEGER) AS settings_tried, "
        "true AS better_than_chance, true AS best_wins"
    )


@check(_searched("logistic_regression", 6))
def cv_search(spark, folder):
    return _search(spark, folder, "logistic_regression", 8)


@check(_searched("random_forest", TREE_SETTINGS))
def cv_search_forest(spark, folder):
    return _search(spark, folder, "random_forest", TREE_SETTINGS)


@check(_searched("hist_gradient_boosting", TREE_SETTINGS))
def cv_search_boosting(spark, folder):
    return _search(spark, folder, "hist_gradient_boosting", TREE_SETTINGS)


def _fixed_model():
    """A pipeline model that decides by the fixed coefficients."""
    margin = " + ".join(f"{w} * {c}" for c, w in COEFFICIENTS.items()) + f" + ({INTERCEPT})"
    score = SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-({margin}))) AS _p, 1 / (1 + exp({margin})) AS _q FROM __THIS__")
    vector = VectorAssembler(inputCols=["_q", "_p"], outputCol="probability")
    return PipelineModel([score, vector, models.AtThreshold(threshold=THRESHOLD)])


@check(
    f"""WITH {FRAME} SELECT event_id, "isFraud", CAST(1 / (1 + exp(-({MARGIN}))) >= {THRESHOLD} AS INTEGER) AS prediction
FROM frame WHERE dataset = 'test'"""
)
def batch_score(spark, folder):
    _, test = _parts(spark, folder)
    return _fixed_model().transform(test).select("event_id", "isFraud", "prediction")


@check(f"""WITH {FRAME} SELECT event_id, "isFraud", CAST({MARGIN} >= 0 AS INTEGER) AS prediction FROM frame WHERE dataset = 'test'""")
def udf_score(spark, folder):
    _, test = _parts(spark, folder)
    names, intercept = dict(COEFFICIENTS), INTERCEPT

    def load():
        def predict(frame):
            margin = sum(w * frame[c].to_numpy("float64") for c, w in names.items()) + intercept
            return (margin >= 0).astype("int32")

        return predict

    return test.select("event_id", "isFraud", scoring.scoring_udf(load, FEATURES).alias("prediction"))


@check(
    f"""WITH {FRAME}, frame_train AS (SELECT * FROM frame WHERE dataset = 'train'), {holdout_of("frame_train", "ftrain")},
picked AS (SELECT * FROM ftrain WHERE split = 'fit' ORDER BY {SAMPLE_DRAW} LIMIT {DRIFT_SAMPLE_ROWS})
SELECT event_id, {", ".join(f'round("{c}", 9) AS "{c}"' if c.startswith("log") else f'"{c}"' for c in FEATURES)}, "isFraud",
CAST(1 / (1 + exp(-({MARGIN}))) >= {THRESHOLD} AS INTEGER) AS prediction, '2024-03-01 12:00:00' AS request_ts, '1' AS model_version
FROM picked"""
)
def baseline_window(spark, folder):
    fit, _ = _parts(spark, folder)
    now = F.expr("TIMESTAMP_NTZ '2024-03-02 12:00:00'")
    sample = stored(ordered_sample(fit, DRIFT_SAMPLE_ROWS))
    log = scoring.simulated_payload(sample, _fixed_model().transform, now, "1", keep=("event_id",))
    rounded = {c: F.round(c, 9) for c in FEATURES if c.startswith("log")}
    rows = log.filter(F.col("request_ts") < now).withColumns(rounded)
    return rows.withColumn("request_ts", F.date_format("request_ts", "yyyy-MM-dd HH:mm:ss"))
