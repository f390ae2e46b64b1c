"""Data-quality profile of a transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import TXN, TxnColumns
from riskloom.functions.columns import entity_class, is_class


def _cents(value: Column) -> Column:
    """Round to two places. A sum of doubles differs in its last digits from run to run, so that
    noise is cut first; else a mean that lies on half a cent would be rounded either way."""
    return F.round(F.round(value, 9), 2)


def label_distribution(df: DataFrame, label: str = TXN.label) -> DataFrame:
    """Rows and percentage per label value, four decimals."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("total")).scalar()
    percentage = F.round(F.col("row_count") / total * 100, 4).alias("percentage")
    return counts.select(label, "row_count", percentage).orderBy(label)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, in key order."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).orderBy(*keys)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One wide row with the number of nulls of every column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus rows over ``columns`` (all by default).

    Name the business columns of an ingested table: its batch columns make every row distinct.
    Counting per distinct row first lets copies collapse before the shuffle.
    """
    per_row = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("copies"))
    return per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
    )


def amount_validity(df: DataFrame, amount: str = TXN.amount) -> DataFrame:
    """Rows, negative and zero amounts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(amount) < 0).alias("negative_amounts"),
        F.count_if(F.col(amount) == 0).alias("zero_amounts"),
    )


def amount_by_type(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """Rows, average and largest amount per transaction type, busiest type first."""
    return (
        df.groupBy(cols.kind)
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            _cents(F.avg(cols.amount)).alias("avg_amount"),
            F.round(F.max(cols.amount), 2).alias("max_amount"),
        )
        .orderBy(F.desc("transactions"), cols.kind)
    )


def entity_pairs(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """Rows per (sender class, receiver class), most frequent first."""
    return (
        df.groupBy(entity_class(cols.sender).alias("orig_type"), entity_class(cols.receiver).alias("dest_type"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "orig_type", "dest_type")
    )


def entity_flags(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """Rows per entity flags and label, most frequent first."""
    return (
        df.groupBy(
            is_class(cols.sender, "C").alias("orig_is_customer"),
            is_class(cols.receiver, "C").alias("dest_is_customer"),
            is_class(cols.receiver, "M").alias("dest_is_merchant"),
            cols.label,
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "orig_is_customer", "dest_is_customer", "dest_is_merchant", cols.label)
    )


def profile_cells(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """The table folded to one row per (type, label, sender class, receiver class).

    One pass over the data. The label, type, amount and entity reports follow from these few
    rows by summing up, see ``profile_reports``.
    """
    amount = F.col(cols.amount)
    return df.groupBy(
        cols.kind,
        cols.label,
        entity_class(cols.sender).alias("orig_type"),
        entity_class(cols.receiver).alias("dest_type"),
    ).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(amount).alias("amount_count"),
        F.sum(amount).alias("amount_sum"),
        F.max(amount).alias("amount_max"),
        F.count_if(amount < 0).alias("negative_amounts"),
        F.count_if(amount == 0).alias("zero_amounts"),
    )


def profile_reports(cells: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """All grouped reports of the profile in one frame, by grouping sets over the cells.

    ``report`` names the grouping; the columns it does not group by are null.
    """
    keys = [cols.kind, cols.label, "orig_type", "dest_type"]
    sets = [[], [cols.label], [cols.kind], [cols.kind, cols.label], ["orig_type", "dest_type"]]
    grouped = cells.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("_set"),
        F.sum("row_count").alias("row_count"),
        _cents(F.try_divide(F.sum("amount_sum"), F.sum("amount_count"))).alias("avg_amount"),
        F.round(F.max("amount_max"), 2).alias("max_amount"),
        F.sum("negative_amounts").alias("negative_amounts"),
        F.sum("zero_amounts").alias("zero_amounts"),
    )
    # grouping_id has one bit per key, 1 where the key is folded away.
    names = {15: "all", 11: "label", 7: "type", 3: "type_label", 12: "entity_pair"}
    report = F.coalesce(*[F.when(F.col("_set") == i, name) for i, name in names.items()])
    return grouped.select(
        report.alias("report"),
        cols.kind,
        F.col(cols.label).cast("string").alias(cols.label),
        "orig_type",
        "dest_type",
        "row_count",
        "avg_amount",
        "max_amount",
        "negative_amounts",
        "zero_amounts",
    )


def table_check(df: DataFrame, label: str = TXN.label) -> DataFrame:
    """Rows, frauds, fraud percentage and column count of a written table."""
    frauds = F.count_if(F.col(label) == 1)
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("row_count"),
        frauds.alias("fraud_count"),
        F.round(F.try_divide(100 * frauds, rows), 4).alias("fraud_percentage"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Whether ``key`` can be a primary key: rows, distinct values, nulls, verdict."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    counts = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("copies"))), F.lit(0)).alias("null_keys"),
    )
    unique = (F.col("row_count") == F.col("distinct_keys")) & (F.col("null_keys") == 0)
    return counts.withColumn("is_primary_key", unique)
