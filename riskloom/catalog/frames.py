"""Inputs of the queries, all derived from the given tables.

No model takes part here: a stand-in score is a column of the data, so that both engines rank
the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import FEATURES
from riskloom.functions.columns import long_form
from riskloom.operators.curve import average_precision, pr_curve, run_metrics
from riskloom.operators.features import feature_frame
from riskloom.operators.sampling import exact_stratified_holdout, search_sample, stratified_folds, time_split
from riskloom.operators.selection import champion_history
from riskloom.session import stored
from riskloom.sources.events import read_events, transactions

# Stand-in models: name and the feature that serves as its score.
STAND_INS = {
    "amount_score": "log_amount",
    "sender_score": "log_orig_txn_count",
    "hour_score": "hour_of_day",
}
STAND_IN_FLAG = 5.0


def txn(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return transactions(read_events(spark, folder), keep)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def features(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return feature_frame(txn(spark, folder, keep), keep=keep)


def stored_features(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The feature table as training and monitoring meet it: written once, then read by column."""
    return stored(features(spark, folder, keep), "dataset")


def train_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of the training period, marked 'fit' or 'val'; stored, as samples pass over them several times."""
    train = time_split(txn(spark, folder)).filter(F.col("dataset") == "train")
    return stored(exact_stratified_holdout(train, 0.12), "split")


def fit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return train_rows(spark, folder).filter(F.col("split") == "fit")


def bake_off(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature rows scored by every stand-in: one row per transaction and algorithm."""
    scores = long_form({name: F.col(c) for name, c in STAND_INS.items()}, "algorithm", "score")
    return rows.select("event_id", "isFraud", *keep, scores)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run per stand-in, with the full metric record."""
    frame = stored_features(spark, folder)
    train = stored(exact_stratified_holdout(frame.filter(F.col("dataset") == "train"), 0.12), "split")
    fit = train.filter(F.col("split") == "fit")
    sample = bake_off(stratified_folds(search_sample(fit)), keep=("fold",))
    per_fold = average_precision(pr_curve(sample, "score", by=["algorithm", "fold"]), ["algorithm", "fold"])
    cv = per_fold.groupBy("algorithm").agg(F.avg("average_precision").alias("cv_best_score_on_sample"))
    record = run_metrics(
        bake_off(train.filter(F.col("split") == "val")),
        bake_off(frame.filter(F.col("dataset") == "test")),
        "score",
        0.60,
        cv,
    )
    return record.select(F.concat(F.lit("run-"), "algorithm").alias("run_id"), "algorithm", "metrics")


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """One model version per stand-in and day with frauds; its metric is that day's AP."""
    scored = bake_off(stored_features(spark, folder), keep=("simulation_day",))
    by = ["algorithm", "simulation_day"]
    daily = average_precision(pr_curve(scored, "score", by=by), by)
    return daily.filter(F.col("average_precision").isNotNull()).select(
        F.col("algorithm").alias("model"), F.col("simulation_day").alias("version"), F.col("average_precision").alias("metric")
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    return champion_history(versions(spark, folder))


def payload(spark: SparkSession, folder: str) -> DataFrame:
    """Every transaction as a scored request; amounts of the last calendar day are shifted."""
    rows = features(spark, folder, keep=("ts",))
    day = F.to_date("ts")
    last_day = read_events(spark, folder).agg(F.max(F.to_date("ts")).alias("d")).scalar()
    shift = F.when(day == last_day, F.col("log_amount") * 3).otherwise(F.col("log_amount"))
    rows = rows.withColumn("log_amount", shift)
    log = rows.select(
        "event_id",
        *FEATURES,
        "isFraud",
        (F.col("log_amount") >= STAND_IN_FLAG).cast("int").alias("prediction"),
        F.col("ts").alias("request_ts"),
        F.when(F.col("event_id") % 3 == 0, "1").otherwise("2").alias("model_version"),
    )
    return stored(log)
