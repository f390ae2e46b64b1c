"""Batch scoring and the simulated drift windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import DRIFT_AMOUNT_FACTOR, FEATURES, TXN
from riskloom.operators.models import positive_probability

_MODEL_COLUMNS = ("features", "scaled", "rawPrediction", "probability")


def score(df: DataFrame, model: Model, threshold: float | None = None) -> DataFrame:
    """Add ``probability`` (of fraud) and the 0/1 ``prediction``, all inside the JVM.

    Without a threshold, the model's own prediction is kept.
    """
    out = model.transform(df).withColumn("_p", positive_probability())
    flagged = F.col("prediction") if threshold is None else F.col("_p") >= threshold
    out = out.withColumn("prediction", flagged.cast("int")).drop(*_MODEL_COLUMNS)
    return out.withColumnRenamed("_p", "probability")


def scoring_udf(load: Callable[[], Callable[[pd.DataFrame], pd.Series]], features: Sequence[str] = FEATURES) -> Column:
    """A 0/1 prediction column from a model that Spark ML does not know.

    ``load`` runs once per task and returns the predict function, which gets whole Arrow batches
    with the features in order.
    """
    names = list(features)

    @F.pandas_udf("int")
    def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            frame = pd.concat(batch, axis=1)
            frame.columns = names
            yield pd.Series(model(frame)).astype("int32")

    return predict(*[F.col(c) for c in names])


def as_payload(
    scored: DataFrame,
    request_ts: Column,
    model_version: str,
    features: Sequence[str] = FEATURES,
    label: str = TXN.label,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Scored rows in the layout of the inference log."""
    return scored.select(
        *keep,
        *features,
        label,
        "prediction",
        request_ts.alias("request_ts"),
        F.lit(model_version).alias("model_version"),
    )


def shifted(df: DataFrame, column: str = "log_amount", factor: float = DRIFT_AMOUNT_FACTOR) -> DataFrame:
    """The frame with one column scaled: an injected drift."""
    return df.withColumn(column, F.col(column) * factor)


def simulated_payload(
    sample: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    as_of: datetime | Column,
    model_version: str,
    features: Sequence[str] = FEATURES,
    label: str = TXN.label,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Baseline rows a day before ``as_of``, and the same rows shifted, scored anew, at ``as_of``.

    Both times are timestamps. ``sample`` must be reproducible, see ``ordered_sample``.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    yesterday = now - F.expr("INTERVAL 1 DAY")
    baseline = as_payload(predict(sample), yesterday, model_version, features, label, keep)
    drifted = as_payload(predict(shifted(sample)), now, model_version, features, label, keep)
    return baseline.unionByName(drifted)


def rows_per_window(payload: DataFrame, width: str = "1 day") -> DataFrame:
    return payload.groupBy(F.window("request_ts", width).alias("window")).agg(F.count(F.lit(1)).alias("row_count"))
