"""Data-quality profile queries."""

from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import features, table, txn
from riskloom.catalog.sql import FRAME, TXN
from riskloom.operators import ingest, quality

W = f"WITH {TXN} "


def _placed(rows):
    """The few rows of a sorted report with their places, so that the order is compared too."""
    return rows.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


#: All source columns. The amount enters as a decimal, which both engines print alike.
ROW_HASH_COLUMNS = ["step", "type", "amount_text", "nameOrig", "nameDest", "isFraud"]
AMOUNT_TEXT = "CAST(CAST(amount AS DECIMAL(18, 4)) AS VARCHAR)"
HASH_SQL = f"""sha256(concat_ws('||', step, "type", {AMOUNT_TEXT}, "nameOrig", "nameDest", "isFraud"))"""
DUPLICATE_COLUMNS = ["type", "nameOrig", "nameDest", "isFraud"]


@check(
    W + 'SELECT "isFraud", count(*) AS row_count, round(count(*) / (SELECT count(*) FROM txn) * 100, 4) AS percentage, '
    'row_number() OVER (ORDER BY "isFraud") AS place FROM txn GROUP BY 1'
)
def label_distribution(spark, folder):
    return _placed(quality.label_distribution(txn(spark, folder)))


@check(W + 'SELECT "type", "isFraud", count(*) AS row_count FROM txn GROUP BY ALL')
def type_label_counts(spark, folder):
    return quality.count_by(txn(spark, folder), "type", "isFraud")


@check(
    W
    + "SELECT "
    + ", ".join(
        f'count(*) FILTER ("{c}" IS NULL) AS "{c}"'
        for c in ["event_id", "step", "type", "amount", "nameOrig", "nameDest", "isFraud"]
    )
    + " FROM txn"
)
def null_counts(spark, folder):
    return quality.null_counts(txn(spark, folder))


@check(
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (nullif({c}, {v}) IS NULL) AS {c}"
        for c, v in [("c_custkey", "1"), ("c_name", "''"), ("c_nationkey", "0"), ("c_acctbal", "0.0"), ("c_mktsegment", "'BUILDING'")]
    )
    + " FROM customer"
)
def null_counts_with_nulls(spark, folder):
    nulls = {"c_custkey": 1, "c_name": "", "c_nationkey": 0, "c_acctbal": 0.0, "c_mktsegment": "BUILDING"}
    customer = table(spark, folder, "customer")
    return quality.null_counts(customer.select(*[F.nullif(c, F.lit(v)).alias(c) for c, v in nulls.items()]))


@check(
    W
    + """, per_row AS (SELECT "type", "nameOrig", "nameDest", "isFraud", count(*) AS copies FROM txn GROUP BY ALL)
SELECT CAST(sum(copies) AS BIGINT) AS row_count, count(*) AS distinct_count,
       CAST(sum(copies - 1) AS BIGINT) AS duplicate_count FROM per_row"""
)
def duplicate_rows(spark, folder):
    return quality.duplicate_rows(txn(spark, folder), DUPLICATE_COLUMNS)


@check(
    "SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_count, "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS distinct_count FROM lineitem"
)
def duplicate_whole_rows(spark, folder):
    return quality.duplicate_rows(table(spark, folder, "lineitem"))


@check(
    W + "SELECT count(*) AS row_count, count(*) FILTER (amount < 0) AS negative_amounts, "
    "count(*) FILTER (amount = 0) AS zero_amounts FROM txn"
)
def amount_validity(spark, folder):
    return quality.amount_validity(txn(spark, folder))


@check(
    "SELECT count(*) AS row_count, count(*) FILTER (c_acctbal < 0) AS negative_amounts, "
    "count(*) FILTER (c_acctbal = 0) AS zero_amounts FROM customer"
)
def balance_validity(spark, folder):
    return quality.amount_validity(table(spark, folder, "customer"), "c_acctbal")


@check(
    W + 'SELECT "type", count(*) AS transactions, round(avg(amount), 2) AS avg_amount, '
    'round(max(amount), 2) AS max_amount, row_number() OVER (ORDER BY count(*) DESC, "type") AS place FROM txn GROUP BY 1'
)
def amount_by_type(spark, folder):
    return _placed(quality.amount_by_type(txn(spark, folder)))


@check(
    W + 'SELECT substr("nameOrig", 1, 1) AS orig_type, substr("nameDest", 1, 1) AS dest_type, '
    "count(*) AS row_count, row_number() OVER (ORDER BY count(*) DESC, orig_type, dest_type) AS place FROM txn GROUP BY orig_type, dest_type"
)
def entity_pair_counts(spark, folder):
    return _placed(quality.entity_pairs(txn(spark, folder)))


@check(
    W
    + """SELECT CAST(substr("nameOrig", 1, 1) = 'C' AS INTEGER) AS orig_is_customer,
CAST(substr("nameDest", 1, 1) = 'C' AS INTEGER) AS dest_is_customer,
CAST(substr("nameDest", 1, 1) = 'M' AS INTEGER) AS dest_is_merchant, "isFraud", count(*) AS row_count,
row_number() OVER (ORDER BY count(*) DESC, orig_is_customer, dest_is_customer, dest_is_merchant, "isFraud") AS place
FROM txn GROUP BY orig_is_customer, dest_is_customer, dest_is_merchant, "isFraud" """
)
def entity_flag_counts(spark, folder):
    return _placed(quality.entity_flags(txn(spark, folder)))


@check(
    W
    + """, cells AS (SELECT *, substr("nameOrig", 1, 1) AS orig_type, substr("nameDest", 1, 1) AS dest_type FROM txn)
SELECT CASE grouping("type", "isFraud", orig_type, dest_type)
         WHEN 15 THEN 'all' WHEN 11 THEN 'label' WHEN 7 THEN 'type' WHEN 3 THEN 'type_label' ELSE 'entity_pair' END AS report,
       "type", CAST("isFraud" AS VARCHAR) AS "isFraud", orig_type, dest_type, count(*) AS row_count,
       round(avg(amount), 2) AS avg_amount, round(max(amount), 2) AS max_amount,
       count(*) FILTER (amount < 0) AS negative_amounts, count(*) FILTER (amount = 0) AS zero_amounts
FROM cells
GROUP BY GROUPING SETS ((), ("isFraud"), ("type"), ("type", "isFraud"), (orig_type, dest_type))"""
)
def quality_profile(spark, folder):
    return quality.profile_reports(quality.profile_cells(txn(spark, folder)))


@check(
    W
    + f"""SELECT event_id, {HASH_SQL} AS row_hash, 'batch-1' AS batch_id FROM txn"""
)
def row_hash(spark, folder):
    rows = ingest.stamp(_with_text(txn(spark, folder)), "batch-1", columns=ROW_HASH_COLUMNS)
    return rows.select("event_id", "row_hash", "batch_id")


def _with_text(rows):
    return rows.withColumn("amount_text", F.col("amount").cast("decimal(18,4)").cast("string"))


@check(
    W
    + """SELECT event_id, sha256(concat_ws('||',
  length(CAST(event_id AS VARCHAR)) || ':' || event_id, length("type") || ':' || "type",
  coalesce(length(nullif("nameDest", 'M0')) || ':' || nullif("nameDest", 'M0'), '-'))) AS row_hash FROM txn"""
)
def row_hash_null_safe(spark, folder):
    rows = txn(spark, folder).withColumn("nameDest", F.nullif("nameDest", F.lit("M0")))
    return ingest.stamp(rows, "batch-1", columns=["event_id", "type", "nameDest"], safe=True).select("event_id", "row_hash")


MERGE_COLUMNS = ["step", "type", "amount", "nameOrig", "nameDest", "isFraud", "row_hash", "batch_id"]
MERGE_SQL = (
    W
    + f""", hashed AS (SELECT step, "type", amount, "nameOrig", "nameDest", "isFraud", {HASH_SQL} AS row_hash FROM txn),
target AS (SELECT *, 'batch-1' AS batch_id FROM hashed WHERE step <= 480),
source AS (SELECT *, 'batch-2' AS batch_id FROM hashed WHERE step > 240),
merged AS (SELECT * FROM target UNION ALL SELECT * FROM source WHERE row_hash NOT IN (SELECT row_hash FROM target))
"""
)


def _batches(spark, folder):
    rows = _with_text(txn(spark, folder))
    early = ingest.stamp(rows.filter("step <= 480"), "batch-1", columns=ROW_HASH_COLUMNS)
    late = ingest.stamp(rows.filter("step > 240"), "batch-2", columns=ROW_HASH_COLUMNS)
    return early.select(*MERGE_COLUMNS), late.select(*MERGE_COLUMNS)


@check(MERGE_SQL + "SELECT * FROM merged")
def insert_only_merge(spark, folder):
    return ingest.insert_only_merge(*_batches(spark, folder))


@check(
    MERGE_SQL
    + """SELECT batch_id, count(*) AS row_count, count(DISTINCT row_hash) AS distinct_count FROM (
SELECT row_hash, batch_id FROM target UNION ALL SELECT DISTINCT row_hash, batch_id FROM source
WHERE row_hash NOT IN (SELECT row_hash FROM target)) GROUP BY 1"""
)
def insert_only_merge_deduped(spark, folder):
    merged = ingest.insert_only_merge(*_batches(spark, folder), dedupe_source=True)
    return merged.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("row_hash").alias("distinct_count")
    )


@check(
    f"WITH {FRAME} "
    """SELECT dataset, count(*) AS row_count, count(*) FILTER ("isFraud" = 1) AS fraud_count,
round(100 * count(*) FILTER ("isFraud" = 1) / count(*), 4) AS fraud_percentage, 12 AS column_count
FROM frame GROUP BY 1"""
)
def written_table_check(spark, folder):
    frame = features(spark, folder)
    checks = []
    for part in ("train", "test"):
        rows = frame.filter(F.col("dataset") == part).drop("event_id", "dataset")
        checks.append(quality.table_check(rows).withColumn("dataset", F.lit(part)))
    return checks[0].unionByName(checks[1])


@check(
    f"WITH {FRAME} "
    """SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_keys,
count(*) FILTER (event_id IS NULL) AS null_keys, count(*) = count(DISTINCT event_id) AS is_primary_key FROM frame"""
)
def primary_key_check(spark, folder):
    return quality.key_check(features(spark, folder), "event_id")


@check(
    "SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_keys, "
    "count(*) FILTER (l_orderkey IS NULL) AS null_keys, count(*) = count(DISTINCT l_orderkey) AS is_primary_key FROM lineitem"
)
def primary_key_check_fails(spark, folder):
    return quality.key_check(table(spark, folder, "lineitem"), "l_orderkey")
