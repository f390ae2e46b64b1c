"""Ingest, scoring and request windows on streams, by the same operators as in batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.ingest import stamp
from riskloom.operators.scoring import score
from riskloom.sources.tables import merge_into_table


def merge_stream(source: DataFrame, table: str, checkpoint: str, dedupe_source: bool = False) -> StreamingQuery:
    """Insert-only merge of every micro-batch; a repeated batch adds nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = stamp(batch, f"stream-{batch_id}")
        merge_into_table(rows, table, dedupe_source=dedupe_source)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(source: DataFrame, model: PipelineModel, threshold: float) -> DataFrame:
    return score(source, model, threshold)


def request_windows(payload: DataFrame, lateness: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Requests and flagged requests per window, final once the watermark has passed it."""
    return (
        payload.withWatermark("request_ts", lateness)
        .groupBy(F.window("request_ts", width).alias("window"), "model_version")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("prediction").cast("long")).alias("flagged_count"))
    )
