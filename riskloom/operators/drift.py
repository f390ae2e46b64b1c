"""Inference-log windows, their quality, and distribution drift between them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.config import DRIFT_PVALUE, DRIFT_STATISTIC, FEATURES, TABLE_LEVEL_ROW, TXN
from riskloom.functions.columns import ks_pvalue, long_form, ratio
from riskloom.operators.curve import confusion_of
from riskloom.operators.running import running_totals
from riskloom.session import stored


def with_window(payload: DataFrame, ts: str = "request_ts", width: str = "1 day") -> DataFrame:
    """Add ``window``, the tumbling window of the request."""
    return payload.withColumn("window", F.window(ts, width))


def payload_windows(payload: DataFrame, ts: str = "request_ts", width: str = "1 day") -> DataFrame:
    """Requests and flagged requests per window and model version."""
    return (
        with_window(payload, ts, width)
        .groupBy("window", "model_version")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("prediction").cast("long")).alias("flagged_count"))
    )


def inference_quality(payload: DataFrame, label: str = TXN.label, width: str = "1 day") -> DataFrame:
    """Confusion counts and ratios per window and model version, where the label is known."""
    known = with_window(payload, width=width).filter(F.col(label).isNotNull() & F.col("prediction").isNotNull())
    out = confusion_of(known, "prediction", label, ["window", "model_version"])
    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return out.withColumn("accuracy", ratio(F.col("tp") + F.col("tn"), rows))


def window_sizes(windowed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored: rows of each window of a group, with the window before it, that one's rows, and the one after.

    One pass over the log. What follows is as small as the calendar at the width chosen, which may be
    seconds, so the neighbours come from running totals in buckets and not from one task.
    """
    sizes = windowed.groupBy(*by, "window").agg(F.count(F.lit(1)).alias("row_count"))
    start = F.unix_micros(F.col("window.start").cast("timestamp"))
    sizes = stored(sizes.withColumn("_at", start).withColumn("_later", -start))
    ahead = running_totals(sizes, "_at", maxima=["_at"], by=by, exclusive=True)
    both = running_totals(ahead, "_at", maxima=["_later"], by=by, descending=True, exclusive=True)
    both = both.select(*by, "window", "row_count", "_at", F.col("run__at").alias("_before"), (-F.col("run__later")).alias("_after"))
    other = sizes.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_at").alias("_other_at"),
        F.col("window").alias("_other"),
        F.col("row_count").alias("_other_count"),
    )

    def neighbour(rows: DataFrame, place: str, window: str, count: str) -> DataFrame:
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        on = reduce(lambda a, b: a & b, [F.col(place) == F.col("_other_at"), *same])
        found = rows.join(other, on, "left").withColumn(window, F.col("_other")).withColumn(count, F.col("_other_count"))
        return found.select(*rows.columns, window, count)

    found = neighbour(neighbour(both, "_before", "_previous", "previous_count"), "_after", "_next", "_next_count")
    return stored(found.select(*by, "window", "row_count", "_previous", "previous_count", "_next"))


def value_counts(windowed: DataFrame, features: Sequence[str] = FEATURES, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` of each non-null value of each feature per window; a row without a time is in no window."""
    long = windowed.select(*by, "window", long_form({c: F.col(c) for c in features}, "column_name", "value"))
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(*by, "window", "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ks_drift(
    payload: DataFrame,
    features: Sequence[str] = FEATURES,
    by: Sequence[str] = (),
    ts: str = "request_ts",
    width: str = "1 day",
) -> DataFrame:
    """Two-sample KS test of every feature between each window and the one before it.

    Rows are folded to counts per (window, column, value) before anything else moves. Each count
    then serves twice, for its own window and as the predecessor of the next. The first window
    has no row. A table-level row per window, with no test, carries its row count.
    """
    by = list(by)
    windowed = with_window(payload, ts, width)
    counts = value_counts(windowed, features, by)
    # Stored, so its size is known: Spark broadcasts it only if it is small.
    sizes = window_sizes(windowed, by)
    neighbours = sizes.select(*by, "window", F.col("_previous").isNotNull().alias("_has_previous"), "_next").alias("_w")
    same = reduce(
        lambda a, b: a & b, [F.col(f"_c.{c}").eqNullSafe(F.col(f"_w.{c}")) for c in [*by, "window"]]
    )
    with_next = counts.alias("_c").join(neighbours, same).select("_c.*", "_has_previous", "_next")
    roles = with_next.withColumn(
        "_role",
        F.explode(
            F.array(
                F.struct(F.when(F.col("_has_previous"), F.col("window")).alias("w"), F.lit(True).alias("now")),
                F.struct(F.col("_next").alias("w"), F.lit(False).alias("now")),
            )
        ),
    )
    paired = roles.filter(F.col("_role.w").isNotNull()).select(
        *by,
        F.col("_role.w").alias("window"),
        "column_name",
        "value",
        F.when(F.col("_role.now"), F.col("n")).otherwise(0).alias("now"),
        F.when(F.col("_role.now"), 0).otherwise(F.col("n")).alias("before"),
    )
    groups = [*by, "window", "column_name"]
    runs = running_totals(
        paired,
        "value",
        sums=["now", "before"],
        by=groups,
        cuts_per=["column_name"],
        cuts_from=counts.filter(F.col("n") > 0),
    )
    gap = F.abs(
        F.try_divide(F.col("run_now"), F.col("all_now")) - F.try_divide(F.col("run_before"), F.col("all_before"))
    )
    tested = runs.groupBy(*groups).agg(
        F.max(gap).alias("statistic"), F.max("all_now").alias("row_count"), F.max("all_before").alias("previous_count")
    )
    pvalue = ks_pvalue(F.col("statistic"), F.col("row_count"), F.col("previous_count"))
    per_column = tested.filter(F.col("statistic").isNotNull()).select(
        *groups,
        F.struct("statistic", pvalue.alias("pvalue")).alias("ks_test"),
        "row_count",
        "previous_count",
    )
    table_level = sizes.filter(F.col("previous_count").isNotNull()).select(
        *by,
        "window",
        F.lit(TABLE_LEVEL_ROW).alias("column_name"),
        F.lit(None).cast("struct<statistic:double,pvalue:double>").alias("ks_test"),
        "row_count",
        "previous_count",
    )
    return per_column.unionByName(table_level)


def latest_window(drift: DataFrame) -> DataFrame:
    """Start of the newest window, one row; null on an empty table."""
    return drift.agg(F.max("window.start").alias("latest_window"))


def in_latest_window(drift: DataFrame) -> DataFrame:
    newest = latest_window(drift).scalar()
    return drift.filter(F.col("window.start") == newest)


def breaches(
    drift: DataFrame, statistic: float = DRIFT_STATISTIC, pvalue: float = DRIFT_PVALUE
) -> DataFrame:
    """Columns of the newest window whose test is beyond both limits. No test is no breach."""
    return (
        in_latest_window(drift)
        .filter(F.col("column_name") != TABLE_LEVEL_ROW)
        .filter((F.col("ks_test.statistic") > statistic) & (F.col("ks_test.pvalue") < pvalue))
    )


def drift_verdict(
    drift: DataFrame, statistic: float = DRIFT_STATISTIC, pvalue: float = DRIFT_PVALUE
) -> DataFrame:
    """One row: breached columns, whether there is drift, and whether to retrain."""
    count = breaches(drift, statistic, pvalue).agg(F.count(F.lit(1)).alias("breached_columns"))
    found = F.col("breached_columns") > 0
    return count.select("breached_columns", found.alias("drift_detected"), found.alias("retrain"))
