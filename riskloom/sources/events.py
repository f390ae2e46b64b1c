"""Transactions derived from an event table.

The label and the account classes are made from the event's own values by a fixed rule, so the
view is the same in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type to transaction type.
TYPE_OF_EVENT = {
    "purchase": "PAYMENT",
    "click": "CASH_IN",
    "view": "DEBIT",
    "signup": "TRANSFER",
    "error": "CASH_OUT",
}


def _epoch_second(ts: str) -> Column:
    """Whole seconds of a zoneless timestamp, whatever the session's time zone."""
    day = F.unix_date(F.to_date(ts)).cast("long")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def transactions(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event rows as transactions; ``keep`` names event columns to carry along.

    Hours count from the first event. That number stays in the plan as a scalar subquery over the bare
    column, which Parquet statistics can answer; nothing runs while the plan is built.
    """
    first = events.agg(F.min("ts").alias("ts")).select(_epoch_second("ts").alias("first")).scalar()
    kind = F.coalesce(*[F.when(F.col("event_type") == e, t) for e, t in TYPE_OF_EVENT.items()])
    parsed = events.select("*", F.get_json_object("props", "$.k").cast("long").alias("k"))
    k = F.col("k")
    rows = parsed.select(
        "event_id",
        (F.floor((_epoch_second("ts") - first) / 3600) + 1).cast("int").alias("step"),
        kind.alias("type"),
        F.col("value").alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        F.concat(F.when(k % 3 == 0, "M").otherwise("C"), k.cast("string")).alias("nameDest"),
        *keep,
    )
    suspicious = F.col("type").isin("TRANSFER", "CASH_OUT") & (F.col("amount") > 100)
    drawn = F.substring(F.md5(F.col("event_id").cast("string")), 1, 1) < "8"
    label = F.when(suspicious & drawn, 1).otherwise(0).alias("isFraud")
    return rows.select("event_id", "step", "type", "amount", "nameOrig", "nameDest", label, *keep)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")
