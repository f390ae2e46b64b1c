"""Splits, samples and folds that give the same rows on every run.

Every draw is a hash of a stable unique key (``sample_hash``), so membership of a row does not
depend on partitioning, on retries after a lost executor, or on the rest of the plan. "The k
smallest draws" are found by counting hash prefixes, not by sorting: the counts are at most
65,536 per class, and the last step looks at one part in 2**32 of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.config import TRAIN_SHARE_OF_STEPS, TXN, TxnColumns
from riskloom.functions.columns import hex_share, sample_hash
from riskloom.operators.running import running_totals
from riskloom.session import stored

_DIGITS = 4


def time_split(df: DataFrame, share: float = TRAIN_SHARE_OF_STEPS, cols: TxnColumns = TXN) -> DataFrame:
    """Mark each row 'train' up to ``int(max step * share)`` and 'test' after it.

    A row without a step is in neither period. The maximum stays in the plan as a scalar
    subquery, so nothing is pulled to the driver and the split can reach the scan.
    """
    edge = df.agg((F.max(cols.step) * F.lit(share)).cast("int").alias("split_step")).scalar()
    return df.withColumn("dataset", F.when(F.col(cols.step) <= edge, "train").when(F.col(cols.step).isNotNull(), "test"))


def split_summary(df: DataFrame, part: str, label: str = TXN.label) -> DataFrame:
    """Rows, positives and positive share per part."""
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(label).cast("long")).alias("fraud_count"),
        F.avg(F.col(label).cast("double")).alias("fraud_share"),
    )


def count_by_label(df: DataFrame, part: str = "dataset", label: str = TXN.label) -> DataFrame:
    """Rows per (part, label); rows outside every part are left out."""
    return df.filter(F.col(part).isNotNull()).groupBy(part, label).agg(F.count(F.lit(1)).alias("row_count"))


def _boundary(counts: DataFrame, value: str) -> DataFrame:
    """Per class, the first ``value`` at which the running count reaches ``_want``."""
    order = Window.partitionBy("_class").orderBy(value)
    seen = counts.withColumn("_upto", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.col("_upto") - F.col("_n")
    hit = seen.filter((before < F.col("_want")) & (F.col("_want") <= F.col("_upto")))
    return hit.withColumn("_want", F.col("_want") - before).drop("_n", "_upto")


def hash_cutoffs(draws: DataFrame, quotas: DataFrame) -> DataFrame:
    """The draw up to which each class fills its quota.

    ``draws`` has (_class, _draw), ``quotas`` has (_class, _want) with one row per class.
    A class with a quota of 0 has no row in the result.
    """
    first, second = F.substring("_draw", 1, _DIGITS), F.substring("_draw", _DIGITS + 1, _DIGITS)
    n = F.count(F.lit(1)).alias("_n")

    level1 = draws.groupBy("_class", first.alias("_p1")).agg(n).join(F.broadcast(quotas), "_class")
    edge1 = _boundary(level1, "_p1")
    near = draws.withColumn("_p1", first).join(F.broadcast(edge1), ["_class", "_p1"])
    level2 = near.groupBy("_class", "_p1", "_want", second.alias("_p2")).agg(n)
    edge2 = _boundary(level2, "_p2")
    nearest = (
        draws.withColumn("_p1", first)
        .withColumn("_p2", second)
        .join(F.broadcast(edge2), ["_class", "_p1", "_p2"])
        .groupBy("_class", "_want", "_draw")
        .agg(n)
    )
    return _boundary(nearest, "_draw").select("_class", F.col("_draw").alias("_cutoff"))


def _take(df: DataFrame, klass: Column, draw: Column, quotas: DataFrame) -> DataFrame:
    """Add ``_taken``: whether the row is among its class's smallest draws."""
    cutoffs = hash_cutoffs(df.select(klass.alias("_class"), draw.alias("_draw")), quotas)
    marked = df.withColumn("_class", klass).join(F.broadcast(cutoffs), "_class", "left")
    taken = F.coalesce(draw <= F.col("_cutoff"), F.lit(False))
    return marked.withColumn("_taken", taken).drop("_class", "_cutoff")


def ordered_sample(df: DataFrame, rows: int, key: str = TXN.key, seed: int = 42) -> DataFrame:
    """``rows`` rows with the smallest draws: a fixed random sample of a stored table."""
    draw = sample_hash(key, "sample", seed)
    # One class, whose number comes from the data: a constant on both sides would turn the joins with
    # the quota into products.
    klass = F.when(draw < "~", 0)
    total = df.agg(F.min(klass).alias("_class"), F.least(F.count(F.lit(1)), F.lit(rows)).alias("_want"))
    return _take(df, klass, draw, total).filter("_taken").drop("_taken")


def bernoulli_holdout(df: DataFrame, fraction: float, key: str = TXN.key, seed: int = 42) -> DataFrame:
    """Add ``split``: 'val' where the row's draw is below ``fraction``, 'fit' for the rest.

    One comparison per row and no shuffle. Not stratified: class sizes are right in expectation only. Use
    ``exact_stratified_holdout`` where they matter, as training does.
    """
    draw = F.substring(sample_hash(key, "holdout", seed), 1, 8)
    return df.withColumn("split", F.when(draw < hex_share(fraction), "val").otherwise("fit"))


def exact_stratified_holdout(
    df: DataFrame, fraction: float, label: str = TXN.label, key: str = TXN.key, seed: int = 42
) -> DataFrame:
    """Add ``split``: 'val' for ``ceil(fraction * n)`` rows in exact proportion of the classes, else 'fit'.

    The fit share of each class is rounded down and the rows left over go to the classes with
    the largest remainders.
    """
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_size"))
    everything = Window.partitionBy(F.lit(0))
    n = F.sum("_size").over(everything)
    sizes = sizes.withColumn("_n", n).withColumn("_fit_n", F.col("_n") - F.ceil(F.col("_n") * F.lit(fraction)))
    sizes = sizes.withColumn("_base", F.expr("(_fit_n * _size) div _n")).withColumn(
        "_rest", F.expr("(_fit_n * _size) % _n")
    )
    left_over = F.col("_fit_n") - F.sum("_base").over(everything)
    place = F.row_number().over(everything.orderBy(F.col("_rest").desc(), "_class"))
    fit = F.col("_base") + F.when(place <= left_over, 1).otherwise(0)
    quotas = sizes.select("_class", (F.col("_size") - fit).alias("_want"))
    draw = sample_hash(key, "holdout", seed)
    marked = _take(df, F.col(label), draw, quotas)
    return marked.withColumn("split", F.when(F.col("_taken"), "val").otherwise("fit")).drop("_taken")


def search_sample(
    df: DataFrame, negatives_per_positive: int = 40, label: str = TXN.label, key: str = TXN.key, seed: int = 42
) -> DataFrame:
    """Every positive and ``min(negatives, 40 * positives)`` negatives, without replacement."""
    quotas = df.agg(
        F.min(F.when(F.col(label) == 0, F.col(label))).alias("_class"),
        F.least(
            F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1) * F.lit(negatives_per_positive)
        ).alias("_want"),
    )
    marked = _take(df, F.col(label), sample_hash(key, "search", seed), quotas)
    return marked.filter((F.col(label) == 1) | F.col("_taken")).drop("_taken")


def stratified_folds(
    df: DataFrame, folds: int = 3, label: str = TXN.label, key: str = TXN.key, seed: int = 42
) -> DataFrame:
    """Add ``fold`` 0..folds-1, dealt in turn within each class by draw.

    Counts of a class differ by one at the most between folds. The turn is a running count over the
    draws of the class, cut into buckets, so no class is sorted in one task.
    """
    draw = F.conv(F.substring(sample_hash(key, "fold", seed), 1, 15), 16, 10).cast("long")
    # Read three times below, and a sample takes several passes to draw.
    drawn = stored(df.withColumn("_draw", draw).withColumn("_one", F.lit(1).cast("long")))
    ranked = running_totals(drawn, "_draw", sums=["_one"], by=[label], unique=True)
    return ranked.select(*df.columns, ((F.col("run__one") - 1) % folds).cast("int").alias("fold"))
