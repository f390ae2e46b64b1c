"""Inference-log and drift queries."""

from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import STAND_IN_FLAG, payload, stored_features
from riskloom.catalog.sql import (
    CONFUSION_RATIOS,
    FRAME,
    PAYLOAD,
    SAMPLE_DRAW,
    confusion_columns,
    drift_of,
)
from riskloom.config import DRIFT_PVALUE, DRIFT_SAMPLE_ROWS, DRIFT_STATISTIC
from riskloom.operators import drift, scoring, summaries
from riskloom.operators.sampling import ordered_sample
from riskloom.session import stored


def _day(df):
    """The window as its day, to compare across engines."""
    return df.withColumn("day", F.date_format("window.start", "yyyy-MM-dd")).drop("window")


def _flat(df):
    tests = {"statistic": F.round("ks_test.statistic", 9), "pvalue": F.round("ks_test.pvalue", 9)}
    return _day(df).withColumns(tests).drop("ks_test")


def _predict(df):
    return df.withColumn("prediction", (F.col("log_amount") >= STAND_IN_FLAG).cast("int"))


def _simulated(spark, folder):
    train = stored_features(spark, folder).filter(F.col("dataset") == "train")
    now = F.expr("TIMESTAMP_NTZ '2024-03-02 12:00:00'")
    sample = ordered_sample(train, DRIFT_SAMPLE_ROWS)
    return stored(scoring.simulated_payload(sample, _predict, now, "1", keep=("event_id",)))


SIMULATED = (
    FRAME
    + f""",
picked AS (SELECT * FROM frame WHERE dataset = 'train' ORDER BY {SAMPLE_DRAW} LIMIT {DRIFT_SAMPLE_ROWS}),
sim AS (SELECT * EXCLUDE (ts), '2024-03-01' AS day, TIMESTAMP '2024-03-01 12:00:00' AS request_ts FROM picked
        UNION ALL
        SELECT * EXCLUDE (ts) REPLACE (log_amount * 3 AS log_amount), '2024-03-02', TIMESTAMP '2024-03-02 12:00:00' FROM picked)"""
)


@check(
    f"""WITH {SIMULATED} SELECT event_id, round(log_amount, 9) AS log_amount, "isFraud",
CAST(log_amount >= 5.0 AS INTEGER) AS prediction, strftime(request_ts, '%Y-%m-%d %H:%M:%S') AS request_ts,
'1' AS model_version FROM sim"""
)
def shifted_window(spark, folder):
    return _simulated(spark, folder).select(
        "event_id",
        F.round("log_amount", 9).alias("log_amount"),
        "isFraud",
        "prediction",
        F.date_format("request_ts", "yyyy-MM-dd HH:mm:ss").alias("request_ts"),
        "model_version",
    )


@check(f"WITH {SIMULATED} SELECT day, count(*) AS row_count FROM sim GROUP BY 1")
def rows_per_window(spark, folder):
    return _day(scoring.rows_per_window(_simulated(spark, folder)))


@check(
    f"WITH {SIMULATED}, {drift_of('sim')}, hit AS (SELECT count(*) AS n FROM drift WHERE column_name <> ':table' "
    "AND statistic > 0.2 AND pvalue < 0.05 AND day = (SELECT max(day) FROM drift)) "
    "SELECT n AS breached_columns, n > 0 AS drift_detected, n > 0 AS retrain FROM hit"
)
def simulated_drift_verdict(spark, folder):
    return drift.drift_verdict(drift.ks_drift(_simulated(spark, folder)))


@check(
    f"WITH {PAYLOAD} SELECT day, model_version, count(*) AS row_count, CAST(sum(prediction) AS BIGINT) AS flagged_count "
    "FROM payload GROUP BY ALL"
)
def payload_windows(spark, folder):
    return _day(drift.payload_windows(payload(spark, folder)))


@check(
    f"""WITH {PAYLOAD}, cm AS (SELECT day, model_version, {confusion_columns('prediction = 1')} FROM payload GROUP BY ALL)
SELECT day, model_version, tp, fp, fn, tn, {CONFUSION_RATIOS},
       round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy FROM cm"""
)
def inference_quality(spark, folder):
    out = _day(drift.inference_quality(payload(spark, folder)))
    names = ("precision", "recall", "alerts_per_fraud", "flagged_rate", "accuracy")
    return out.withColumns({c: F.round(c, 9) for c in names})


DRIFT = f"WITH {PAYLOAD}, {drift_of('payload')}"
LATEST = "day = (SELECT max(day) FROM drift)"
BREACH = "column_name <> ':table' AND statistic > 0.2 AND pvalue < 0.05"


@check(
    DRIFT + "SELECT day, column_name, round(statistic, 9) AS statistic, round(pvalue, 9) AS pvalue, row_count, "
    "previous_count FROM drift"
)
def ks_drift_metrics(spark, folder):
    return _flat(drift.ks_drift(payload(spark, folder)))


@check(
    f"WITH {PAYLOAD}, {drift_of('payload', ['model_version'])} SELECT model_version, day, column_name, "
    "round(statistic, 9) AS statistic, round(pvalue, 9) AS pvalue, row_count, previous_count FROM drift"
)
def ks_drift_by_model(spark, folder):
    return _flat(drift.ks_drift(payload(spark, folder), by=["model_version"]))


@check(DRIFT + "SELECT max(day) AS latest_window FROM drift")
def latest_drift_window(spark, folder):
    newest = drift.latest_window(drift.ks_drift(payload(spark, folder)))
    return newest.select(F.date_format("latest_window", "yyyy-MM-dd").alias("latest_window"))


@check(
    DRIFT + "SELECT day, column_name, round(statistic, 9) AS statistic, round(pvalue, 9) AS pvalue, row_count, "
    f"previous_count FROM drift WHERE {LATEST} AND {BREACH}"
)
def drift_breaches(spark, folder):
    return _flat(drift.breaches(drift.ks_drift(payload(spark, folder))))


@check(
    DRIFT + f", hit AS (SELECT count(*) AS n FROM drift WHERE {LATEST} AND {BREACH}) "
    "SELECT n AS breached_columns, n > 0 AS drift_detected, n > 0 AS retrain FROM hit"
)
def drift_verdict(spark, folder):
    return drift.drift_verdict(drift.ks_drift(payload(spark, folder)))


#: Few enough that most values at sf0.01 lie between two points.
FEW_POINTS = 16


@check(
    f"""WITH {PAYLOAD}, {drift_of('payload')},
ranks AS (SELECT day, column_name, v, n, CAST(sum(n) OVER (PARTITION BY day, column_name ORDER BY v) AS BIGINT) AS upto,
                 CAST(sum(n) OVER (PARTITION BY day, column_name) AS BIGINT) AS total FROM c)
SELECT day, column_name, round(v, 9) AS value, upto - n AS below, upto, total AS row_count FROM ranks
WHERE upto * {FEW_POINTS} // total > (upto - n) * {FEW_POINTS} // total"""
)
def window_ranks(spark, folder):
    found = _day(summaries.window_summaries(payload(spark, folder), points=FEW_POINTS))
    return found.select("day", "column_name", "row_count", F.inline("points")).withColumn("value", F.round("value", 9))


@check(
    DRIFT + "SELECT column_name, row_count, previous_count, statistic > 0.2 AND pvalue < 0.05 AS breach, true AS bounds_hold "
    f"FROM drift WHERE {LATEST} AND column_name <> ':table'"
)
def summary_breaches(spark, folder):
    """What the bounds decide, else the exact test; and whether the bounds hold the exact statistic."""
    rows = payload(spark, folder)
    table = stored(summaries.window_summaries(rows, points=FEW_POINTS))
    now, before = (summaries.at_window(table, start) for start in summaries.newest_windows(table))
    decided = summaries.bounded_breaches(summaries.ks_bounds(now, before))
    exact = drift.in_latest_window(stored(drift.ks_drift(rows))).select("column_name", "ks_test.*")
    beyond = (F.col("statistic") > DRIFT_STATISTIC) & (F.col("pvalue") < DRIFT_PVALUE)
    return decided.join(exact, "column_name").select(
        "column_name",
        "row_count",
        "previous_count",
        F.coalesce("breach", beyond).alias("breach"),
        F.col("statistic").between(F.col("statistic_low"), F.col("statistic_high")).alias("bounds_hold"),
    )
