"""Row identity and insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions.columns import row_digest
from riskloom.operators.skew import SPREAD, heavy_by_sketch
from riskloom.session import stored


def stamp(
    raw: DataFrame,
    batch_id: str,
    ingest_ts: datetime | Column | None = None,
    columns: Sequence[str] | None = None,
    safe: bool = False,
) -> DataFrame:
    """Add ``row_hash`` over the source columns, ``ingest_ts`` and ``batch_id``."""
    if ingest_ts is None:
        ingest_ts = F.current_timestamp()
    elif isinstance(ingest_ts, datetime):
        ingest_ts = F.lit(ingest_ts)
    return raw.select(
        "*",
        row_digest(columns or raw.columns, safe).alias("row_hash"),
        ingest_ts.alias("ingest_ts"),
        F.lit(batch_id).alias("batch_id"),
    )


def without_copies(df: DataFrame, key: str) -> DataFrame:
    """One row of each key. Rows with a null key are no copies of each other and all stay."""
    keyed, unkeyed = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    return keyed.dropDuplicates([key]).unionByName(unkeyed)


def new_rows(target: DataFrame, source: DataFrame, key: str = "row_hash", dedupe_source: bool = False) -> DataFrame:
    """Rows of ``source`` whose key the target lacks.

    Copies within the source are all kept unless ``dedupe_source``. Rows with a null key match
    nothing, are no copies of each other and are all new.

    The source is computed once and stored: its key column is read for heavy keys, its rows for the join. A key copied
    very often in the source would put all its copies into one task of the join. Such keys (fewer than a thousand)
    are looked up in the target by themselves; their rows, and those without a key, pass the join under spread-out
    routes that match nothing. Of the target only the key column is read, once, or twice where keys are heavy.
    """
    seen = target.select(F.col(key).alias("_seen"))
    rows = stored(without_copies(source, key) if dedupe_source else source)
    marked = rows.withColumn("_apart", F.col(key).isNull())
    if not dedupe_source:
        heavy = stored(heavy_by_sketch(rows.filter(F.col(key).isNotNull()), key))
        if not heavy.isEmpty():
            found = seen.join(F.broadcast(heavy), F.col("_seen") == F.col(key), "left_semi").distinct()
            known = heavy.join(found, F.col(key) == F.col("_seen"), "left")
            # Fewer than a thousand rows, whatever the sizes of source and target.
            known = F.broadcast(known.select(F.col(key).alias("_heavy"), F.col("_seen").isNotNull().alias("_known")))
            marked = rows.join(known, F.col(key) == F.col("_heavy"), "left").filter("_known is not true")
            marked = marked.withColumn("_apart", F.col(key).isNull() | F.col("_heavy").isNotNull())
    text = isinstance(rows.schema[key].dataType, StringType)
    salt = F.concat(F.lit("~"), F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)).cast("string"))
    route = F.when(F.col("_apart"), salt).otherwise(F.col(key) if text else F.col(key).cast("string"))
    # Keys that are text are joined as they stand, so that a target bucketed by them is not shuffled.
    other = F.col("_seen") if text else F.col("_seen").cast("string")
    marked = marked.withColumn("_route", route)
    return marked.join(seen, (F.col("_route") == other) & ~F.col("_apart"), "left_anti").select(*source.columns)


def insert_only_merge(
    target: DataFrame, source: DataFrame, key: str = "row_hash", dedupe_source: bool = False
) -> DataFrame:
    """The target after the merge. Rows already there are never changed or removed."""
    return target.unionByName(new_rows(target, source, key, dedupe_source))
