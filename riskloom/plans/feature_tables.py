"""From the bronze table to published train and test feature tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.config import FEATURE_TABLE, TXN, TxnColumns
from riskloom.operators.features import check_same_columns, feature_frame, row_ids
from riskloom.operators.quality import table_check
from riskloom.session import stored
from riskloom.sources.tables import publish_all

KEY = "txn_id"


def build_feature_tables(
    spark: SparkSession,
    bronze: str,
    train_name: str,
    test_name: str,
    cols: TxnColumns | None = None,
) -> dict[str, DataFrame]:
    """Write both feature tables, each with a checked primary key ``txn_id``.

    Ids follow the row key, so building the same tables again gives the same ids and, with them, the
    same splits, samples and folds.
    """
    cols = cols or replace(TXN, key="row_hash")
    frame = stored(feature_frame(spark.table(bronze), cols), "dataset")
    parts = {
        name: row_ids(frame.filter(F.col("dataset") == part), cols.key, KEY).select(*FEATURE_TABLE, KEY)
        for name, part in ((train_name, "train"), (test_name, "test"))
    }
    check_same_columns(parts[train_name], parts[test_name])
    return publish_all(parts, KEY, "One row per transaction, label included")


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, frauds and column counts of the written tables."""
    frames = [table_check(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out
