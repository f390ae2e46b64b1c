"""Drift from summaries of windows: a window is read once, later comparisons read its summary.

A summary holds, for each column, exact ranks at values about ``1 / points`` of the window apart. What lies between two
of these values is known to be between their ranks, so the two-sample KS statistic of two summaries lies between bounds
at most about ``1 / points`` of either window apart, and equals them where every value is in the summary. A column is
decided when both bounds fall on the same side of the limits; only the others need the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import DRIFT_PVALUE, DRIFT_STATISTIC, FEATURES, TABLE_LEVEL_ROW
from riskloom.functions.columns import ks_pvalue
from riskloom.operators.drift import value_counts, with_window
from riskloom.operators.running import running_totals
from riskloom.session import stored

#: Ranks kept of a window and column, at most.
SUMMARY_POINTS = 1024
#: P-values this close to their limit are not decided by bounds: the series is rounded.
ROUNDING = 1e-9
POINTS_TYPE = "array<struct<value:double,below:bigint,upto:bigint>>"


def window_summaries(
    payload: DataFrame,
    features: Sequence[str] = FEATURES,
    ts: str = "request_ts",
    width: str = "1 day",
    points: int = SUMMARY_POINTS,
) -> DataFrame:
    """``window, column_name, row_count, points``: each column's ranks, and a row ``:table`` with the window's rows.

    A value is a point if the rows up to it pass another ``1 / points`` of the window's non-null rows, so there are at most
    ``points`` of them and the greatest value is one. ``below`` counts the rows with a smaller value, ``upto`` those with
    the value too. A column of nulls only has no row. NaN is a value, the greatest.
    """
    windowed = with_window(payload, ts, width)
    counts = stored(value_counts(windowed, features))
    groups = ["window", "column_name"]
    ranked = running_totals(counts, "value", sums=["n"], by=groups, unique=True, cuts_per=["column_name"])
    passed = F.expr(f"run_n * {points} div all_n > (run_n - n) * {points} div all_n")
    point = F.struct("value", (F.col("run_n") - F.col("n")).alias("below"), F.col("run_n").alias("upto"))
    found = ranked.filter(passed).groupBy(*groups).agg(
        F.max("all_n").alias("row_count"), F.array_sort(F.collect_list(point)).cast(POINTS_TYPE).alias("points")
    )
    sizes = windowed.filter(F.col("window").isNotNull()).groupBy("window").agg(F.count(F.lit(1)).alias("row_count"))
    whole = sizes.select(
        "window", F.lit(TABLE_LEVEL_ROW).alias("column_name"), "row_count", F.lit(None).cast(POINTS_TYPE).alias("points")
    )
    return found.unionByName(whole)


def newest_windows(summaries: DataFrame, n: int = 2) -> list:
    """Starts of the last ``n`` windows with rows, the newest first."""
    rows = summaries.filter(F.col("column_name") == TABLE_LEVEL_ROW).select(F.col("window.start").alias("start"))
    return [r["start"] for r in rows.orderBy(F.desc("start")).limit(n).collect()]


def ks_bounds(now: DataFrame, before: DataFrame) -> DataFrame:
    """``column_name, statistic_low, statistic_high, row_count, previous_count`` from the summaries of two windows.

    A column without a value in one of them has no row. A column's points, at most twice ``SUMMARY_POINTS``, are one group.
    """

    def ranks(rows: DataFrame, name: str) -> DataFrame:
        points = rows.filter(F.col("points").isNotNull()).select("column_name", F.inline("points"))
        return points.withColumnsRenamed({"below": f"{name}_below", "upto": f"{name}_upto"})

    both = ranks(now, "now").unionByName(ranks(before, "before"), allowMissingColumns=True)
    sides = ("now", "before")
    known = both.groupBy("column_name", "value").agg(*[F.max(f"{s}_{p}").alias(f"{s}_{p}") for s in sides for p in ("below", "upto")])
    column = Window.partitionBy("column_name")
    order = column.orderBy("value")
    back = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shares: dict[str, Column] = {}
    for s in sides:
        size = F.max(f"{s}_upto").over(column)
        last = F.coalesce(F.last(f"{s}_upto", ignorenulls=True).over(back), F.lit(0))
        following = F.coalesce(F.first(f"{s}_below", ignorenulls=True).over(ahead), size)
        found = {
            # Share of the rows up to the value, and of those below it, at least and at most.
            "upto_least": last,
            "upto_most": F.coalesce(F.col(f"{s}_upto"), following),
            "below_least": F.coalesce(F.col(f"{s}_below"), last),
            "below_most": following,
        }
        shares |= {f"{s}_{k}": F.try_divide(v, size) for k, v in found.items()} | {f"{s}_size": size}
    rows = known.select("column_name", "value", *[v.alias(k) for k, v in shares.items()])
    # Between two points the share is at least that up to the first and at most that below the second.
    rows = rows.withColumns({f"{s}_from": F.lag(f"{s}_upto_least", 1, 0.0).over(order) for s in sides})

    def apart(least: str, most: str) -> list[Column]:
        """How far one share lies above the other: for the lower bound surely, for the upper bound possibly."""
        pairs = (sides, sides[::-1])
        return [F.col(f"{a}_{least}") - F.col(f"{b}_{most}") for a, b in pairs]

    low = F.greatest(F.lit(0.0), *apart("upto_least", "upto_most"), *apart("below_least", "below_most"))
    high = F.greatest(F.lit(0.0), *apart("upto_most", "upto_least"), *apart("below_most", "from"))
    out = rows.groupBy("column_name").agg(
        F.max(low).alias("statistic_low"),
        F.max(high).alias("statistic_high"),
        F.max("now_size").alias("row_count"),
        F.max("before_size").alias("previous_count"),
    )
    return out.filter(F.col("row_count").isNotNull() & F.col("previous_count").isNotNull())


def bounded_breaches(bounds: DataFrame, statistic: float = DRIFT_STATISTIC, pvalue: float = DRIFT_PVALUE) -> DataFrame:
    """The bounds with those of the p-value, and ``breach``: true or false where they decide, else null.

    The p-value falls as the statistic rises, so each bound of one gives the other's opposite.
    """
    p = {
        "pvalue_low": ks_pvalue(F.col("statistic_high"), F.col("row_count"), F.col("previous_count")),
        "pvalue_high": ks_pvalue(F.col("statistic_low"), F.col("row_count"), F.col("previous_count")),
    }
    surely = (F.col("statistic_low") > statistic) & (F.col("pvalue_high") < pvalue - ROUNDING)
    never = (F.col("statistic_high") <= statistic) | (F.col("pvalue_low") >= pvalue + ROUNDING)
    return bounds.withColumns(p).withColumn("breach", F.when(surely, True).when(never, False))


def at_window(summaries: DataFrame, start: object) -> DataFrame:
    return summaries.filter(F.col("window.start") == F.lit(start))


def undecided(decided: DataFrame) -> list[str]:
    """Names of the columns whose bounds leave open whether they are beyond the limits; as few as the features at most."""
    return [r[0] for r in decided.filter(F.col("breach").isNull()).select("column_name").collect()]
