"""Running totals over a global order, without sending the order to one task.

A window without ``partitionBy`` sorts everything in a single task. Here the order is cut into
buckets at approximate quantiles. Each bucket is summed up; a small frame of bucket totals gives
each bucket its starting value, which enters the bucket's window as an extra first row. So the
only shuffle of the data is the one by bucket, and every task holds about ``1 / buckets`` of it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

MAX_BUCKETS = 4096
SUMMARY_GROUPS = 64


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, between 16 and ``MAX_BUCKETS``."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, min(MAX_BUCKETS, wanted))


def _with_bucket(df: DataFrame, values: DataFrame, order: str, buckets: int, per: Sequence[str]) -> DataFrame:
    """Add ``_bucket``: the number of cut points below the row's value."""
    shares = [i / buckets for i in range(1, buckets)]
    # Quantiles of groups of tasks first, then quantiles of those, so that no task receives the
    # summaries of all others. The groups are of about equal size.
    quantiles = F.percentile_approx(order, shares, 20 * buckets)
    group = F.pmod(F.spark_partition_id(), F.lit(SUMMARY_GROUPS)).alias("_part")
    parts = values.select(*per, order, group).groupBy(*per, "_part").agg(quantiles.alias("_q"))
    cuts = parts.select(*per, F.explode("_q").alias(order)).groupBy(*per).agg(quantiles.alias("_cuts"))
    # Totals and rows must see the same cuts, so they are computed once and stored; nothing here depends
    # on whether Spark recognises two copies of a plan as one.
    cuts = stored(cuts)
    if per:
        # One row per column name, so as many rows as the unpivoted table was wide.
        same = reduce(lambda a, b: a & b, [F.col(f"_d.{c}").eqNullSafe(F.col(f"_k.{c}")) for c in per])
        rows = df.alias("_d").join(F.broadcast(cuts.alias("_k")), same, "left").select("_d.*", "_k._cuts")
    else:
        rows = df.withColumn("_cuts", cuts.scalar())
    # Binary search, one projection per halving: plain expressions that compile, where a
    # higher-order function over the array would be interpreted for every row.
    rows = rows.withColumn("_bucket", F.lit(0))
    step = 1 << ((buckets - 1).bit_length() - 1)
    while step:
        beyond = F.get("_cuts", F.col("_bucket") + (step - 1)) < F.col(order)
        rows = rows.withColumn("_bucket", F.col("_bucket") + F.when(beyond, step).otherwise(0))
        step >>= 1
    return rows.drop("_cuts")


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str] = (),
    maxima: Sequence[str] = (),
    by: Sequence[str] = (),
    descending: bool = False,
    exclusive: bool = False,
    unique: bool = False,
    ties: Sequence[str] = (),
    cuts_per: Sequence[str] = (),
    cuts_from: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``run_<c>`` for each summed or maximised column and ``all_<c>`` for each group's total.

    Totals run over ``order`` within each ``by`` group and take in every row with an equal value.
    Where the order is ``unique`` in its group, say so: there are no equal values to look for. It may also be unique
    together with the columns in ``ties``: rows of equal order are in one bucket and follow each other by these.
    With ``exclusive`` the totals stop before the row, which needs a unique order.
    ``cuts_per`` names columns of few values, a subset of ``by``, whose value ranges differ.
    ``cuts_from`` is a smaller frame with the same values, where there is one; the cuts decide
    about balance only, never about the result.
    """
    buckets = max(2, buckets or bucket_count(df))
    tracked = [*sums, *maxima]
    if cuts_from is None:
        cuts_from = df
    rows = _with_bucket(df, cuts_from, order, buckets, list(cuts_per))

    def total(name: str) -> Column:
        return F.sum(name) if name in sums else F.max(name)

    per_bucket = rows.groupBy(*by, "_bucket").agg(*[total(c).alias(c) for c in tracked])
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    earlier = Window.partitionBy(*by).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *by,
        "_bucket",
        *[total(c).over(earlier).alias(c) for c in tracked],
        *[total(c).over(Window.partitionBy(*by)).alias(f"all_{c}") for c in tracked],
        F.lit(0).alias("_is_row"),
    )
    both = starts.unionByName(rows.withColumn("_is_row", F.lit(1)), allowMissingColumns=True)

    row_order = F.col(order).desc() if descending else F.col(order).asc()
    cell = Window.partitionBy(*by, "_bucket").orderBy("_is_row", row_order, *ties)
    if exclusive:
        upto = cell.rowsBetween(Window.unboundedPreceding, -1)
    elif unique:
        upto = cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        upto = cell.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.select(
        *df.columns,
        "_is_row",
        *[total(c).over(upto).alias(f"run_{c}") for c in tracked],
        *[F.max(f"all_{c}").over(upto).alias(f"all_{c}") for c in tracked],
    )
    return out.filter("_is_row = 1").drop("_is_row")
