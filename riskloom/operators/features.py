"""Row, entity and frequency features of transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskloom.config import (
    ENCODED_TYPES,
    FEATURE_TABLE,
    FEATURES,
    NON_FEATURES,
    TRAIN_SHARE_OF_STEPS,
    TXN,
    TxnColumns,
)
from riskloom.functions.columns import day_of_run, hour_of_day, is_class, one_hot
from riskloom.operators.running import running_totals
from riskloom.operators.sampling import time_split
from riskloom.operators.skew import HEAVY_SHARE, lookup


def time_features(cols: TxnColumns = TXN) -> list[Column]:
    """Amount and time features of a row. ``log1p`` of an amount at or below -1 is null."""
    return [
        F.log1p(cols.amount).alias("log_amount"),
        (F.col(cols.amount) == 0).cast("int").alias("amount_is_zero"),
        hour_of_day(cols.step).alias("hour_of_day"),
        day_of_run(cols.step).alias("simulation_day"),
    ]


def entity_features(cols: TxnColumns = TXN) -> list[Column]:
    return [
        is_class(cols.sender, "C").alias("orig_is_customer"),
        is_class(cols.receiver, "C").alias("dest_is_customer"),
        is_class(cols.receiver, "M").alias("dest_is_merchant"),
    ]


def row_features(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """All features that need nothing but the row, in one projection."""
    return df.select(
        "*", *time_features(cols), *entity_features(cols), *one_hot(cols.kind, ENCODED_TYPES)
    )


def preview(df: DataFrame, columns: Sequence[str], key: str = TXN.key, rows: int = 20) -> DataFrame:
    """The first rows by key, so that a report shows the same rows every time."""
    return df.select(key, *columns).orderBy(key).limit(rows)


def entity_frequency(train: DataFrame, entity: str, name: str) -> DataFrame:
    """Transactions per entity in the training period."""
    return train.groupBy(entity).agg(F.count(F.lit(1)).alias(name))


def with_train_frequency(
    df: DataFrame, history: DataFrame, entity: str, name: str, spread_by: str = TXN.key
) -> DataFrame:
    """Add how often ``entity`` occurs in ``history`` among rows with ``dataset`` 'train', else 0.

    ``history`` holds both periods. Counts include the row itself and later training rows; test
    rows see training counts only. Both periods share one count per entity and one lookup. Counts
    are combined map-side, so a busy entity costs one row per task; its transactions take the
    broadcast route.
    """
    counts = history.groupBy(entity).agg(
        F.count_if(F.col("dataset") == "train").alias(name), F.count(F.lit(1)).alias("_all")
    )
    bound = history.agg((F.count(F.lit(1)) * HEAVY_SHARE).alias("bound")).scalar()
    found = lookup(
        df,
        counts.filter(F.col("_all") <= bound),
        counts.filter(F.col("_all") > bound),
        entity,
        [name],
        F.col(spread_by),
    )
    return found.fillna(0, subset=[name])


def with_frequencies(df: DataFrame, cols: TxnColumns = TXN) -> DataFrame:
    """Sender and receiver training counts and their logarithms."""
    out = with_train_frequency(df, df, cols.sender, "orig_txn_count_train", cols.key)
    out = with_train_frequency(out, df, cols.receiver, "dest_txn_count_train", cols.key)
    return out.select(
        "*",
        F.log1p("orig_txn_count_train").alias("log_orig_txn_count"),
        F.log1p("dest_txn_count_train").alias("log_dest_txn_count"),
    )


def feature_frame(
    txn: DataFrame, cols: TxnColumns = TXN, keep: Sequence[str] = (), share: float = TRAIN_SHARE_OF_STEPS
) -> DataFrame:
    """Transactions to the feature table: key, period, ``keep``, then the table's columns.

    Filter on ``dataset`` for one period. Rows in neither period are left out.
    """
    split = time_split(txn, share, cols)
    needed = {cols.key, cols.step, cols.kind, cols.amount, cols.sender, cols.receiver, cols.label, *keep}
    rows = split.select(*[c for c in txn.columns if c in needed], "dataset").filter(F.col("dataset").isNotNull())
    # The lookups move rows between tasks, so they run on the raw columns only; everything that
    # the row alone decides is computed after them.
    counted = with_frequencies(rows, cols)
    return row_features(counted, cols).select(cols.key, "dataset", *keep, *FEATURE_TABLE)


def feature_columns(df: DataFrame, also_not: Sequence[str] = ()) -> list[str]:
    """All columns that are not label, key or batch columns."""
    return [c for c in df.columns if c not in {*NON_FEATURES, *also_not}]


def check_same_columns(train: DataFrame, test: DataFrame) -> None:
    if train.columns != test.columns:
        raise ValueError(f"columns of the two periods: {train.columns} and {test.columns}")


def check_features_present(features: Sequence[str], test: DataFrame) -> None:
    missing = sorted(set(features) - set(test.columns))
    if missing:
        raise ValueError(f"features without a column to score on: {missing}")


def assemble_and_scale(features: Sequence[str] = FEATURES) -> Pipeline:
    """Vector assembly and standardisation. Fit it on the training period only."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="All_features", handleInvalid="error"),
            StandardScaler(inputCol="All_features", outputCol="scaled_features", withMean=True, withStd=True),
        ]
    )


def _key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def row_ids(df: DataFrame, key: str = TXN.key, name: str = "txn_id") -> DataFrame:
    """Number the rows 0, 1, 2, ... by ``key``: numbers by value, other types by a hash of the value.

    Unlike ids taken from partition positions, the numbers are the same on every computation. Keys with the same
    hash follow each other by value. Rows that share a key get the numbers of their group; which copy gets which
    does not matter if they are full copies, as rows with one digest are.
    """
    numeric = isinstance(df.schema[key].dataType, NumericType)
    order = F.col(key) if numeric else _key_hash(F.col(key).cast("string"))
    ones = df.withColumn("_order", order).withColumn("_one", F.lit(1).cast("long"))
    numbered = running_totals(ones, "_order", sums=["_one"], unique=True, ties=() if numeric else [key])
    return numbered.select(*df.columns, (F.col("run__one") - 1).alias(name))


def quick_row_ids(df: DataFrame, name: str = "txn_id") -> DataFrame:
    """Unique ids without a shuffle, to be stored at once: a second computation may differ."""
    return df.withColumn(name, F.monotonically_increasing_id())
