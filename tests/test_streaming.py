from pyspark.sql import functions as F

from riskloom.streaming import flows


def test_merge_stream_is_idempotent(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(50).select(F.col("id").alias("x")).write.parquet(folder)
    stream = spark.readStream.schema("x long").parquet(folder)
    for attempt in ("one", "two"):
        query = flows.merge_stream(stream, "stream_bronze", str(tmp_path / attempt))
        query.awaitTermination()
    assert spark.table("stream_bronze").count() == 50


def test_request_windows(spark, tmp_path):
    folder = str(tmp_path / "log")
    rows = spark.range(48).select(
        (F.timestamp_seconds(F.col("id") * 3600)).alias("request_ts"),
        F.lit("1").alias("model_version"),
        (F.col("id") % 2).cast("int").alias("prediction"),
    )
    rows.write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    query = (
        flows.request_windows(stream)
        .writeStream.format("memory")
        .queryName("windows_out")
        .outputMode("complete")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    query.awaitTermination()
    got = [(r["row_count"], r["flagged_count"]) for r in spark.table("windows_out").collect()]
    assert got == [(24, 12), (24, 12)]
