"""Feature queries, up to the flagship feature table."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import features, stored_features, txn
from riskloom.catalog.sql import FEATURE_COLUMNS, FRAME, SPLIT, TXN
from riskloom.config import ENCODED_TYPES, FEATURE_TABLE, FEATURES
from riskloom.functions.columns import one_hot
from riskloom.operators import features as ops
from riskloom.operators.sampling import time_split

FEATURE_LIST = ", ".join(
    f"round({c}, 9) AS {c}" if c.startswith("log_") else f'"{c}"' for c in FEATURE_TABLE
)


def _rounded(df, names):
    return df.select(*[F.round(c, 9).alias(c) if c.startswith("log_") else F.col(c) for c in names])


@check(
    f"WITH {TXN} SELECT event_id, round(log_amount, 9) AS log_amount, amount_is_zero, hour_of_day, simulation_day "
    f"FROM (SELECT event_id, {FEATURE_COLUMNS} FROM txn)"
)
def txn_time_features(spark, folder):
    rows = txn(spark, folder).select("event_id", *ops.time_features())
    return _rounded(rows, ["event_id", "log_amount", "amount_is_zero", "hour_of_day", "simulation_day"])


@check(
    f"WITH {TXN} SELECT event_id, step, \"type\", amount, round(log_amount, 9) AS log_amount, hour_of_day, simulation_day, "
    f'"isFraud" FROM (SELECT *, {FEATURE_COLUMNS} FROM txn) ORDER BY event_id LIMIT 20'
)
def feature_preview(spark, folder):
    shown = ["step", "type", "amount", "log_amount", "hour_of_day", "simulation_day", "isFraud"]
    rows = ops.row_features(txn(spark, folder))
    return _rounded(ops.preview(rows, shown), ["event_id", *shown])


@check(
    f"""WITH {TXN} SELECT event_id, CASE WHEN "type" = 'TRANSFER' THEN 1 ELSE 0 END AS "type_TRANSFER",
CASE WHEN "type" = 'CASH_OUT' THEN 1 ELSE 0 END AS "type_CASH_OUT" FROM txn"""
)
def one_hot_type(spark, folder):
    return txn(spark, folder).select("event_id", *one_hot("type", ENCODED_TYPES))


@check(f"WITH {SPLIT} SELECT \"nameOrig\", count(*) AS orig_txn_count_train FROM parts WHERE dataset = 'train' GROUP BY 1")
def sender_frequency(spark, folder):
    train = time_split(txn(spark, folder)).filter(F.col("dataset") == "train")
    return ops.entity_frequency(train, "nameOrig", "orig_txn_count_train")


@check(f"WITH {SPLIT} SELECT \"nameDest\", count(*) AS dest_txn_count_train FROM parts WHERE dataset = 'train' GROUP BY 1")
def receiver_frequency(spark, folder):
    train = time_split(txn(spark, folder)).filter(F.col("dataset") == "train")
    return ops.entity_frequency(train, "nameDest", "dest_txn_count_train")


@check(
    f"""WITH {SPLIT}, s AS (SELECT "nameOrig", count(*) AS n FROM parts WHERE dataset = 'train' GROUP BY 1),
r AS (SELECT "nameDest", count(*) AS n FROM parts WHERE dataset = 'train' GROUP BY 1)
SELECT event_id, dataset, "nameOrig", coalesce(s.n, 0) AS orig_txn_count_train, "nameDest",
       coalesce(r.n, 0) AS dest_txn_count_train, "isFraud"
FROM parts LEFT JOIN s USING ("nameOrig") LEFT JOIN r USING ("nameDest")"""
)
def frequency_join(spark, folder):
    rows = ops.with_frequencies(time_split(txn(spark, folder)))
    return rows.select(
        "event_id", "dataset", "nameOrig", "orig_txn_count_train", "nameDest", "dest_txn_count_train", "isFraud"
    )


@check(f"WITH {FRAME} SELECT event_id, {FEATURE_LIST} FROM frame WHERE dataset = 'train'")
def feature_frame_train(spark, folder):
    frame = features(spark, folder).filter(F.col("dataset") == "train")
    return _rounded(frame, ["event_id", *FEATURE_TABLE])


@check(f"WITH {FRAME} SELECT event_id, {FEATURE_LIST} FROM frame WHERE dataset = 'test'")
def feature_frame_test(spark, folder):
    frame = features(spark, folder).filter(F.col("dataset") == "test")
    return _rounded(frame, ["event_id", *FEATURE_TABLE])


@check(f"WITH {TXN} SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS txn_id FROM txn")
def stable_row_id(spark, folder):
    return ops.row_ids(txn(spark, folder)).select("event_id", "txn_id")


@check(
    f"WITH {TXN}, k AS (SELECT md5(CAST(event_id AS VARCHAR)) AS k FROM txn) "
    "SELECT count(*) AS row_count, count(DISTINCT k) AS distinct_ids, CAST(0 AS BIGINT) AS least_id, count(*) - 1 AS greatest_id FROM k"
)
def string_row_id(spark, folder):
    """Ids over a string key: as many as rows, from 0 on without gaps."""
    rows = txn(spark, folder).select(F.md5(F.col("event_id").cast("string")).alias("row_hash"))
    return ops.row_ids(rows, "row_hash").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("txn_id").alias("distinct_ids"),
        F.min("txn_id").alias("least_id"),
        F.max("txn_id").alias("greatest_id"),
    )


@check(f"WITH {TXN} SELECT count(*) AS row_count, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS null_ids FROM txn")
def quick_row_id(spark, folder):
    """Ids that depend on the partitioning: what holds of any."""
    return ops.quick_row_ids(txn(spark, folder)).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("txn_id").alias("distinct_ids"),
        F.count_if(F.col("txn_id").isNull()).alias("null_ids"),
    )


def _scaled(spark, folder):
    # Read twice: by the fit and by the transformation.
    frame = stored_features(spark, folder)
    model = ops.assemble_and_scale().fit(frame.filter(F.col("dataset") == "train"))
    return model.transform(frame)


@check(
    f"WITH {FRAME} SELECT event_id, dataset, "
    + ", ".join(
        f"round(CASE WHEN (SELECT stddev_samp(\"{c}\") FROM frame WHERE dataset = 'train') = 0 THEN 0.0 "
        f"ELSE (\"{c}\" - (SELECT avg(\"{c}\") FROM frame WHERE dataset = 'train')) "
        f"/ (SELECT stddev_samp(\"{c}\") FROM frame WHERE dataset = 'train') END, 6) + 0.0 AS \"{c}\""
        for c in FEATURES
    )
    + " FROM frame"
)
def standardized_features(spark, folder):
    values = _scaled(spark, folder).withColumn("_v", vector_to_array("scaled_features"))
    # Adding zero turns a rounded -0.0 into 0.0.
    scaled = [(F.round(F.col("_v")[i], 6) + F.lit(0.0)).alias(c) for i, c in enumerate(FEATURES)]
    return values.select("event_id", "dataset", *scaled)


@check(
    f"WITH {FRAME} SELECT event_id, dataset, " + ", ".join(f'round(CAST("{c}" AS DOUBLE), 9) + 0.0 AS "{c}"' for c in FEATURES) + " FROM frame"
)
def assembled_pipeline(spark, folder):
    """The raw vector of the fitted pipeline; its scaled one is checked by ``standardized_features``."""
    values = _scaled(spark, folder).withColumn("_v", vector_to_array("All_features"))
    raw = [(F.round(F.col("_v")[i], 9) + F.lit(0.0)).alias(c) for i, c in enumerate(FEATURES)]
    return values.select("event_id", "dataset", *raw)
