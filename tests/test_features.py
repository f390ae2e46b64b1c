from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.config import ENCODED_TYPES, FEATURE_TABLE, TXN
from riskloom.functions.columns import one_hot, row_digest
from riskloom.operators import features, quality
from riskloom.operators.sampling import time_split
from riskloom.operators.skew import heavy_by_sketch

SCHEMA = "event_id long, step int, type string, amount double, nameOrig string, nameDest string, isFraud int"


def one_row(step=1, kind="TRANSFER", amount=1.0, sender="C1", receiver="M1", label=0, key=1):
    return (key, step, kind, amount, sender, receiver, label)


def test_time_features_at_the_edges(rows):
    df = rows([one_row(step=s, key=s) for s in (0, 1, 24, 25)], SCHEMA).select("step", *features.time_features())
    got = {r["step"]: (r["hour_of_day"], r["simulation_day"]) for r in df.collect()}
    assert got == {0: (-1, 0), 1: (0, 1), 24: (23, 1), 25: (0, 2)}


def test_log_of_small_amounts_is_null(rows):
    df = rows([one_row(amount=a, key=i) for i, a in enumerate([-2.0, -1.0, 0.0, None])], SCHEMA)
    got = [r["log_amount"] for r in df.select("event_id", *features.time_features()).orderBy("event_id").collect()]
    assert got == [None, None, 0.0, None]


def test_one_hot_of_unknown_and_null(rows):
    df = rows([("TRANSFER",), ("CASH_OUT",), ("OTHER",), (None,)], "type string")
    got = [tuple(r) for r in df.select(*one_hot("type", ENCODED_TYPES)).collect()]
    assert got == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_digest_collides_by_default_and_not_when_safe(rows):
    data = [("a", None, "b"), ("a", "b", None), ("a||b", None, None)]
    df = rows(data, "x string, y string, z string")
    plain = df.select(row_digest(df.columns).alias("h")).distinct().count()
    safe = df.select(row_digest(df.columns, safe=True).alias("h")).distinct().count()
    assert (plain, safe) == (1, 3)


def test_time_split_leaves_out_missing_steps(rows):
    df = rows([one_row(step=s, key=i) for i, s in enumerate([1, 8, 9, 10, None])], SCHEMA)
    got = {r["event_id"]: r["dataset"] for r in time_split(df).collect()}
    assert got == {0: "train", 1: "train", 2: "test", 3: "test", 4: None}


def skewed(spark, n=6000):
    """A third of the rows share one receiver, others are few per key; some senders are null."""
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.col("id") % 100 + 1).cast("int").alias("step"),
        F.lit("TRANSFER").alias("type"),
        F.lit(2.0).alias("amount"),
        F.when(F.col("id") % 3 == 1, None).otherwise(F.concat(F.lit("C"), (F.col("id") % 2500).cast("string"))).alias("nameOrig"),
        F.when(F.col("id") % 3 == 0, "~7").otherwise(F.concat(F.lit("~"), (F.col("id") % 4096).cast("string"))).alias("nameDest"),
        F.lit(0).alias("isFraud"),
    )


def test_frequencies_with_heavy_and_null_keys(spark):
    """Keys that look like the spread-out routes must not be mistaken for them."""
    split = time_split(skewed(spark))
    got = features.with_frequencies(split).select("event_id", "orig_txn_count_train", "dest_txn_count_train").toPandas()
    frame = split.toPandas()
    train = frame[frame.dataset == "train"]
    for entity, name in (("nameOrig", "orig_txn_count_train"), ("nameDest", "dest_txn_count_train")):
        want = frame[entity].map(train[entity].value_counts()).fillna(0).astype(int)
        merged = got.set_index("event_id")[name].reindex(frame.event_id)
        assert (merged.to_numpy() == want.to_numpy()).all()


def test_sketch_names_the_heavy_key_and_few_others(spark):
    found = [r[0] for r in heavy_by_sketch(skewed(spark), "nameDest", share=0.01).collect()]
    assert "~7" in found
    assert len(found) <= 100


def test_feature_frame_layout_and_missing_sender(spark):
    frame = features.feature_frame(skewed(spark, 600))
    assert frame.columns == ["event_id", "dataset", *FEATURE_TABLE]
    nulls = frame.filter(F.col("event_id") % 3 == 1)
    assert nulls.agg(F.max("log_orig_txn_count")).first()[0] == 0.0


def test_other_column_names(spark):
    names = {"nameOrig": "src", "nameDest": "dst", "isFraud": "y", "event_id": "k"}
    df = skewed(spark, 300).withColumnsRenamed(names)
    cols = replace(TXN, sender="src", receiver="dst", label="y", key="k")
    checked = features.with_frequencies(time_split(df, cols=cols), cols)
    assert checked.count() == 300


def test_scaler_uses_train_only_and_constants_become_zero(rows):
    train = rows([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    model = features.assemble_and_scale(["a", "b"]).fit(train)
    values = [list(r[0]) for r in model.transform(train).select(vector_to_array("scaled_features")).collect()]
    assert [v[0] for v in values] == pytest.approx([-1.0, 0.0, 1.0])
    assert [v[1] for v in values] == [0.0, 0.0, 0.0]
    later = model.transform(rows([(9.0, 6.0)], "a double, b double"))
    assert list(later.select(vector_to_array("scaled_features")).first()[0]) == [7.0, 0.0]


def test_row_ids_are_dense_and_stable(spark):
    df = spark.range(0, 5000, 3).select((F.col("id") * 7).alias("event_id"))
    first = {tuple(r) for r in features.row_ids(df.repartition(7)).collect()}
    second = {tuple(r) for r in features.row_ids(df).collect()}
    assert first == second
    assert sorted(i for _, i in first) == list(range(len(first)))


def test_quick_ids_are_unique(spark):
    df = features.quick_row_ids(spark.range(1000).select(F.col("id").alias("event_id")).repartition(5))
    assert quality.key_check(df, "txn_id").first()["is_primary_key"]


def test_feature_columns_and_schema_checks(rows):
    df = rows([(1, 2.0, 0, "b")], "txn_id long, a double, isFraud int, batch_id string")
    assert features.feature_columns(df) == ["a"]
    with pytest.raises(ValueError):
        features.check_features_present(["a", "z"], df)
    with pytest.raises(ValueError):
        features.check_same_columns(df, df.drop("a"))


def test_ids_of_keys_with_one_hash_follow_the_keys(spark, monkeypatch):
    """All keys share one of three hashes; numbers must not depend on partitions."""
    monkeypatch.setattr(features, "_key_hash", lambda key: F.pmod(F.xxhash64(key), F.lit(3)))
    df = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("row_hash"))
    found = [sorted(tuple(r) for r in features.row_ids(df.repartition(n), "row_hash").collect()) for n in (1, 4, 9)]
    assert found[0] == found[1] == found[2]
    assert sorted(i for _, i in found[0]) == list(range(2000))
