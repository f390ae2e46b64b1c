from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom.operators import ingest
from riskloom.sources import tables

NOW = datetime(2024, 1, 1)


def keys(df):
    return sorted(r["row_hash"] for r in df.collect())


def test_merge_adds_only_new_keys(rows):
    target, source = rows([("h1",)], "row_hash string"), rows([("h1",), ("h2",)], "row_hash string")
    once = ingest.insert_only_merge(target, source)
    assert keys(once) == ["h1", "h2"]
    assert keys(ingest.insert_only_merge(once, source)) == ["h1", "h2"]


def test_copies_in_one_batch(rows):
    target, source = rows([], "row_hash string"), rows([("h1",), ("h1",)], "row_hash string")
    assert keys(ingest.insert_only_merge(target, source)) == ["h1", "h1"]
    assert keys(ingest.insert_only_merge(target, source, dedupe_source=True)) == ["h1"]


def test_heavy_copies_known_and_new(spark):
    """Two keys with a third of the rows each, one known; keys that look like routes; nulls."""
    source = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "~1")
        .when(F.col("id") % 3 == 1, "~2")
        .when(F.col("id") % 300 == 2, None)
        .otherwise(F.concat(F.lit("~"), F.col("id").cast("string")))
        .alias("row_hash"),
        F.col("id"),
    )
    target = spark.createDataFrame([("~1",), ("~5",), ("~8",), ("~8",)], "row_hash string").withColumn("id", F.lit(-1))
    got = ingest.new_rows(target, source).toPandas()
    want = source.toPandas()
    want = want[~want.row_hash.isin(["~1", "~5", "~8"])]
    assert sorted(got.id) == sorted(want.id)
    assert got.columns.tolist() == source.columns


def test_stamp(rows):
    df = ingest.stamp(rows([(1, "a")], "x int, y string"), "b7", NOW)
    assert df.columns == ["x", "y", "row_hash", "ingest_ts", "batch_id"]
    got = df.first()
    assert (got["batch_id"], got["ingest_ts"], len(got["row_hash"])) == ("b7", NOW, 64)
    assert ingest.stamp(rows([(1,)], "x int"), "b").first()["ingest_ts"] is not None


CSV = "step,type,amount,nameOrig,nameDest,isFraud\n1,TRANSFER,10.5,C1,C2,0\n2,CASH_OUT,99.0,C3,M4,1\n"


@pytest.mark.parametrize("buckets", [None, 4])
def test_csv_into_table_twice(spark, tmp_path, buckets):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    name = f"bronze_{buckets or 'plain'}"
    raw = ingest.stamp(tables.read_csv(spark, str(path)), "b1", NOW)
    assert tables.merge_into_table(raw, name, buckets=buckets) == "created"
    path.write_text(CSV + "3,DEBIT,0.0,C5,M1,0\n")
    spark.catalog.refreshByPath(str(path))
    assert tables.ingest_csv(spark, str(path), name, "b2", ingest_ts=NOW) == "merged"
    assert tables.ingest_csv(spark, str(path), name, "b3", ingest_ts=NOW) == "merged"
    counts = {r["batch_id"]: r["count"] for r in spark.table(name).groupBy("batch_id").count().collect()}
    assert counts == {"b1": 2, "b2": 1}


def test_inferred_schema(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    assert dict(tables.read_csv(spark, str(path), schema=None).dtypes)["amount"] == "double"


def test_fixtures(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "a.csv").write_text("x\n1\n2\n")
    assert tables.read_fixture(spark, str(tmp_path / "a.json")).count() == 2
    assert tables.read_fixture(spark, str(tmp_path / "a.csv")).dtypes == [("x", "string")]
    with pytest.raises(ValueError):
        tables.read_fixture(spark, "a.xml")


def test_overwrite_replaces_the_schema(spark, rows):
    tables.overwrite_table(rows([(1,)], "a int"), "replaced")
    tables.overwrite_table(rows([("x", 2.0)], "b string, c double"), "replaced")
    assert spark.table("replaced").columns == ["b", "c"]


def test_append_matches_names(spark, rows):
    tables.append_by_name(rows([(1, "x")], "a int, b string"), "log")
    tables.append_by_name(rows([("y", 2)], "b string, a int"), "log")
    assert sorted(tuple(r) for r in spark.table("log").collect()) == [(1, "x"), (2, "y")]


def test_publish_checks_the_key(spark, rows):
    tables.publish_feature_table(rows([(1, 2.0), (2, 2.0)], "txn_id long, a double"), "silver_ok", "txn_id", "it's fine")
    with pytest.raises(ValueError):
        tables.publish_feature_table(rows([(1, 2.0), (1, 2.0)], "txn_id long, a double"), "silver_bad", "txn_id", "no")


def test_both_tables_or_none(spark, rows):
    good, bad = rows([(1, 2.0), (2, 2.0)], "txn_id long, a double"), rows([(1, 2.0), (1, 2.0)], "txn_id long, a double")
    tables.publish_all({"both_train": good, "both_test": good}, "txn_id", "first")
    with pytest.raises(ValueError, match="both_test"):
        tables.publish_all({"both_train": good.filter("txn_id = 1"), "both_test": bad}, "txn_id", "second")
    assert spark.table("both_train").count() == spark.table("both_test").count() == 2


def test_export_and_schema_report(spark, rows, tmp_path):
    df = rows([(0.5, 0.7)], "target_recall double, threshold double")
    tables.export_csv(df, str(tmp_path / "points"))
    assert spark.read.option("header", True).csv(str(tmp_path / "points")).columns == df.columns
    assert [r["column_name"] for r in tables.schema_report(df).orderBy("position").collect()] == df.columns


def test_null_keys_are_no_copies_of_each_other(rows):
    target = rows([("a", 1)], "k string, v int")
    source = rows([(None, 2), (None, 3), ("a", 4), ("b", 5), ("b", 6)], "k string, v int")
    got = ingest.new_rows(target, source, "k", dedupe_source=True).collect()
    assert sorted(r["v"] for r in got if r["k"] is None) == [2, 3]
    assert [r["k"] for r in got if r["k"]] == ["b"]
    plain = ingest.new_rows(target, source, "k").collect()
    assert sorted(r["v"] for r in plain) == [2, 3, 5, 6]


def test_heavy_keys_at_the_border_are_merged_right(spark):
    """Keys of about a thousandth of the rows each, half of them known, whichever side the sketch puts them on."""
    source = spark.range(60_000).select(F.when(F.col("id") < 6000, F.col("id") % 100).otherwise(F.col("id")).cast("string").alias("k"))
    target = spark.range(0, 100, 2).select(F.col("id").cast("string").alias("k"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = ingest.new_rows(target, source, "k")
        assert got.count() == 54_000 + 50 * 60
        assert got.join(target, "k").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_first_load_keeps_null_keys(spark, rows):
    source = rows([(None, 1), (None, 2), ("a", 3), ("a", 3)], "row_hash string, v int")
    assert tables.merge_into_table(source, "null_keys", dedupe_source=True) == "created"
    assert sorted(r["v"] for r in spark.table("null_keys").collect()) == [1, 2, 3]
    again = rows([("a", 3), ("b", 4)], "row_hash string, v int")
    assert tables.merge_into_table(again, "null_keys", dedupe_source=True) == "merged"
    assert sorted(r["v"] for r in spark.table("null_keys").collect()) == [1, 2, 3, 4]


def scanned(df):
    """Rows that the table scans of a computed frame gave."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("buckets", [None, 3])
def test_row_groups_without_a_key_of_the_batch_are_not_read(spark, buckets):
    name = f"filtered_{buckets or 'plain'}"
    raw = spark.range(0, 200_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("row_hash"), "id")
    spark.conf.set("parquet.block.size", 1 << 20)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.setInt("parquet.block.size", 1 << 20)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.merge_into_table(raw, name, buckets=buckets)
        batch = raw.filter("id = 77").unionByName(spark.createDataFrame([("f" * 64, -1)], "row_hash string, id long"))
        with tables.few_keys(batch, "row_hash") as keys:
            assert len(keys) == 2
            read = spark.table(name).filter(F.col("row_hash").isin(keys)).select("row_hash")
            assert 0 < scanned(read) < 100_000
        assert scanned(spark.table(name).select("row_hash")) == 200_000
        assert tables.merge_into_table(batch, name) == "merged"
        assert spark.table(name).filter("id < 0").count() == 1 and spark.table(name).count() == 200_001
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_batches_are_not_collected(spark):
    with tables.few_keys(spark.range(tables.PUSHED_KEYS + 1).withColumnRenamed("id", "k"), "k") as keys:
        assert keys is None


def test_merge_reads_each_side_at_most_twice(spark, tmp_path):
    source = spark.range(3000).select((F.col("id") % 10).cast("string").alias("row_hash"), "id")
    source.write.parquet(str(tmp_path / "source"))
    spark.range(5).select(F.col("id").cast("string").alias("row_hash"), "id").write.parquet(str(tmp_path / "target"))
    got = ingest.new_rows(spark.read.parquet(str(tmp_path / "target")), spark.read.parquet(str(tmp_path / "source")))
    assert got.count() == 1500
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("target") <= 2 and plan.count("Relation") <= 5


def test_numbers_as_keys(rows):
    source = rows([(i % 7, i) for i in range(700)] + [(None, -1), (None, -2), (1000, 5)], "k long, v int")
    got = ingest.new_rows(rows([(1, 0), (2, 0), (50, 0)], "k long, v int"), source, "k")
    assert got.count() == 500 + 2 + 1
