"""Lookups that hold when one key has a large share of the rows.

A heavy key is one with more than ``HEAVY_SHARE`` of all rows, so there are fewer than
``1 / HEAVY_SHARE`` of them however large the table is. That bound is what allows broadcasting
them. Their rows are answered from the broadcast and travel through the shuffle of the ordinary
lookup under spread-out keys that match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1 / 1000
SPREAD = 4096
SKETCH_GROUPS = 256


def heavy_by_sketch(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> DataFrame:
    """Keys that look heavy to a frequent-items sketch, found without a shuffle of the keys.

    The sketch may name a key too many; callers must only use the answer to choose a route.
    At most ``1 / share`` rows.
    """
    most = int(1 / share)
    tracked = 16 * most
    # Tasks leave one sketch each. They are merged in groups first, so that no task receives the
    # sketches of all others.
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")
    sketches = df.select(F.col(key).alias("k"), group).groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    # Grouped by what is always true: a sketch of no sketches, as a task without rows would have, is an error.
    found = sketches.groupBy(F.col("part") >= 0).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {most})").alias("top"),
        F.sum("n").alias("rows"),
    )
    item = found.select("rows", F.explode("top").alias("top"))
    return item.filter(F.col("top.count") > F.col("rows") * share).select(F.col("top.item").alias(key))


def lookup(
    df: DataFrame,
    table: DataFrame,
    heavy: DataFrame,
    key: str,
    values: Sequence[str],
    spread_by: Column,
) -> DataFrame:
    """Left join ``values`` onto ``df``.

    ``table`` holds each ordinary key once; ``heavy`` holds the heavy keys, with the same
    columns. ``spread_by`` is hashed to spread the rows of heavy and null keys.
    """
    hot = F.broadcast(
        heavy.select(F.col(key).alias("_hot_key"), *[F.col(v).alias(f"_hot_{v}") for v in values])
    )
    cold = table.select(
        F.col(key).cast("string").alias("_cold_key"), *[F.col(v).alias(f"_cold_{v}") for v in values]
    )
    apart = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)).cast("string"))
    marked = df.join(hot, F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_route", F.when(apart, salt).otherwise(F.col(key).cast("string"))
    )
    joined = marked.join(cold, F.col("_route") == F.col("_cold_key"), "left")
    # A route may equal a real key by chance, so the flag decides which side answers.
    picked = [F.when(apart, F.col(f"_hot_{v}")).otherwise(F.col(f"_cold_{v}")).alias(v) for v in values]
    return joined.select(*[F.col(c) for c in df.columns], *picked)
