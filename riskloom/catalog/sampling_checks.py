"""Split, sample and fold queries."""

from pyspark.sql import functions as F

from riskloom.catalog import check
from riskloom.catalog.frames import fit_rows, train_rows, txn
from riskloom.catalog.sql import FIT, FOLD, SAMPLE_DRAW, SPLIT, TXN, search_of
from riskloom.config import DRIFT_SAMPLE_ROWS
from riskloom.operators import models, sampling

TRAIN = f"WITH {SPLIT}, train AS (SELECT * FROM parts WHERE dataset = 'train')"


@check(f'WITH {SPLIT} SELECT dataset, "isFraud", count(*) AS row_count FROM parts WHERE dataset IS NOT NULL GROUP BY ALL')
def time_split_counts(spark, folder):
    return sampling.count_by_label(sampling.time_split(txn(spark, folder))).orderBy("dataset", "isFraud")


BERNOULLI = "substr(md5('holdout:42:' || CAST(event_id AS VARCHAR)), 1, 8) < '1eb851eb'"


@check(TRAIN + f" SELECT event_id, \"isFraud\", CASE WHEN {BERNOULLI} THEN 'val' ELSE 'fit' END AS split FROM train")
def bernoulli_holdout(spark, folder):
    train = sampling.time_split(txn(spark, folder)).filter(F.col("dataset") == "train")
    return sampling.bernoulli_holdout(train, 0.12).select("event_id", "isFraud", "split")


@check(
    f"""WITH {FIT} SELECT split, count(*) AS row_count, CAST(sum("isFraud") AS BIGINT) AS fraud_count,
round(avg("isFraud"), 9) AS fraud_share FROM train GROUP BY 1
UNION ALL SELECT 'test', count(*), CAST(sum("isFraud") AS BIGINT), round(avg("isFraud"), 9) FROM parts WHERE dataset = 'test'"""
)
def split_totals(spark, folder):
    rows = train_rows(spark, folder)
    test = sampling.time_split(txn(spark, folder)).filter(F.col("dataset") == "test").withColumn("split", F.lit("test"))
    rows = rows.unionByName(test)
    totals = sampling.split_summary(rows, "split")
    return totals.withColumn("fraud_share", F.round("fraud_share", 9))


@check(f'WITH {FIT} SELECT event_id, "isFraud", split FROM train')
def stratified_holdout_exact(spark, folder):
    return train_rows(spark, folder).select("event_id", "isFraud", "split")


@check(f"WITH {FIT}, {search_of('fit')} SELECT event_id, \"isFraud\" FROM sample")
def search_sample(spark, folder):
    return sampling.search_sample(fit_rows(spark, folder)).select("event_id", "isFraud")


@check(
    f"""WITH {FIT}, {search_of('fit')} SELECT 'search' AS part, count(*) AS row_count,
CAST(sum("isFraud") AS BIGINT) AS fraud_count, round(avg("isFraud"), 9) AS fraud_share FROM sample"""
)
def search_sample_totals(spark, folder):
    sample = sampling.search_sample(fit_rows(spark, folder)).withColumn("part", F.lit("search"))
    return sampling.split_summary(sample, "part").withColumn("fraud_share", F.round("fraud_share", 9))


@check(f"WITH {FIT}, {search_of('fit')} SELECT event_id, \"isFraud\", {FOLD} AS fold FROM sample")
def stratified_folds(spark, folder):
    sample = sampling.search_sample(fit_rows(spark, folder))
    return sampling.stratified_folds(sample).select("event_id", "isFraud", "fold")


@check(
    f"""WITH {FIT}, {search_of('fit')}, folded AS (SELECT "isFraud", {FOLD} AS fold FROM sample)
SELECT 'fold ' || fold AS part, "isFraud", count(*) AS row_count FROM folded GROUP BY ALL
UNION ALL SELECT split, "isFraud", count(*) FROM train GROUP BY ALL"""
)
def class_shares(spark, folder):
    """Rows per class in every fold and split: what stratification is for."""
    train = train_rows(spark, folder)
    folds = sampling.stratified_folds(sampling.search_sample(train.filter(F.col("split") == "fit")))
    parts = folds.select(F.concat(F.lit("fold "), "fold").alias("part"), "isFraud")
    parts = parts.unionByName(train.select(F.col("split").alias("part"), "isFraud"))
    return parts.groupBy("part", "isFraud").agg(F.count(F.lit(1)).alias("row_count"))


@check(f"WITH {TXN} SELECT event_id, amount FROM txn ORDER BY {SAMPLE_DRAW} LIMIT {DRIFT_SAMPLE_ROWS}")
def ordered_sample(spark, folder):
    return sampling.ordered_sample(txn(spark, folder), DRIFT_SAMPLE_ROWS).select("event_id", "amount")


@check(f"WITH {TXN} SELECT event_id, amount FROM txn ORDER BY {SAMPLE_DRAW} LIMIT 300")
def ordered_sample_of_300(spark, folder):
    """A limit below the number of rows at every size of the tables."""
    return sampling.ordered_sample(txn(spark, folder), 300).select("event_id", "amount")


@check(
    f"""WITH {FIT}, counts AS (SELECT "isFraud", count(*) AS row_count FROM fit GROUP BY 1),
total AS (SELECT sum(row_count) AS n FROM counts)
SELECT mode, "isFraud", row_count,
  round(CASE mode WHEN 'none' THEN 1.0 WHEN 'one_to_twenty' THEN CASE WHEN "isFraud" = 1 THEN 20.0 ELSE 1.0 END
       ELSE n / (2.0 * row_count) END, 9) AS weight
FROM counts, total, (VALUES ('none'), ('one_to_twenty'), ('balanced')) AS m(mode)"""
)
def class_weights(spark, folder):
    fit = fit_rows(spark, folder)
    modes = {"none": None, "one_to_twenty": {0: 1, 1: 20}, "balanced": "balanced"}
    frames = [models.class_weights(fit, mode).withColumn("mode", F.lit(name)) for name, mode in modes.items()]
    out = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return out.select("mode", "isFraud", "row_count", F.round("weight", 9).alias("weight"))
