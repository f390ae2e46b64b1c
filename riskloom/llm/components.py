"""Connected components of a graph given as a table of edges, for any component size.

Large-star and small-star steps in turn: each node's larger neighbours, then its smaller ones, are
linked to the least node it knows. Edges become stars around the least node of each component. A step
is a pre-aggregated minimum by node and a join with it, so no group is collected, and Spark may split
the join of a node with many neighbours. Each round is stored, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import stored


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).head())


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    larger = larger.filter("u <> v").distinct()
    least = larger.groupBy("u").agg(F.min("v").alias("m"))
    smaller = larger.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: every node but the least of each component, and that least node.

    ``edges`` has two columns ``u`` and ``v`` in any order; loops are ignored.
    """
    start = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(start.distinct())
    state = _state(now)
    while state[0]:
        now = stored(_round(now))
        before, state = state, _state(now)
        if state == before:
            break
    return now
