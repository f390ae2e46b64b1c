"""What several operators of this package share: tables, Arrow batches, dealing rows by order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MOST_BUCKETS = 4096
MOST_REMEMBERED = 200_000
LONGEST_REMEMBERED = 64
SLICE_ROWS = 500
BATCH_ROWS = 1000
SUMMARY_GROUPS = 64


class Recent(dict):
    """What ``make`` gives for a key, remembered for the keys met lately.

    Two generations of at most ``times * MOST_REMEMBERED`` keys: a full one becomes the old one, and keys met again move
    into the new one. So keys that are frequent stay, and memory is bounded whatever comes: a key of more than
    ``LONGEST_REMEMBERED`` characters, such as a text without blanks, is made anew each time.
    """

    def __init__(self, make: Callable[[Any], Any], times: int = 1):
        super().__init__()
        self.make, self.old, self.times = make, {}, times

    def __missing__(self, key: Any) -> Any:
        if isinstance(key, str) and len(key) > LONGEST_REMEMBERED:
            return self.make(key)
        if len(self) >= self.times * MOST_REMEMBERED:
            self.old = dict(self)
            self.clear()
        value = self.old[key] if key in self.old else self.make(key)
        self[key] = value
        return value

    def knows(self, key: Any) -> bool:
        return key in self or key in self.old

    def learn(self, keys: Sequence, values: Sequence) -> None:
        """Remember these values, at most ``MOST_REMEMBERED`` at a time."""
        if len(self) + len(keys) > MOST_REMEMBERED:
            self.old = dict(self)
            self.clear()
        self.update(zip(keys, values, strict=True))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in smaller batches, so that few are Python values at the same time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def small_batches(spark: SparkSession) -> None:
    """Let the session pass rows to Python in batches of a size that suits texts.

    The usual ten thousand rows are tens of megabytes of text, which every task holds in the JVM and in Python,
    going and coming; both keep that memory for later stages.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_fields(df: DataFrame, more: str) -> StructType:
    """The frame's fields, whatever their names, and more of them."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def task_count(df: DataFrame) -> int:
    """As many tasks as the session shuffles to, which whoever runs it sets to suit the data."""
    return max(1, min(MOST_BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def cut_points(df: DataFrame, key: str, buckets: int) -> list:
    """At most ``buckets - 1`` values that cut a numeric key into parts of about equal size.

    Summaries of groups of tasks first, then one of those, so that no task gets all summaries.
    The driver receives at most ``MOST_BUCKETS`` numbers.
    """
    buckets = min(buckets, MOST_BUCKETS)
    if buckets < 2:
        return []
    quantiles = F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 20 * buckets)
    group = F.pmod(F.spark_partition_id(), F.lit(SUMMARY_GROUPS)).alias("part")
    parts = df.select(key, group).groupBy("part").agg(quantiles.alias("q"))
    found = parts.select(F.explode("q").alias(key)).agg(quantiles.alias("cuts")).head()[0]
    return sorted(set(found or []))


def bucket_of(key: Column, cuts: Sequence) -> Column:
    """The number of cut points at or below the key, by halving; null keys come first."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.when(key.isNull(), F.lit(0)).otherwise(search(0, len(cuts))).cast("int")


def in_order(df: DataFrame, key: str, ties: Sequence[str] = (), tasks: int | None = None) -> tuple[DataFrame, int]:
    """Deal rows to tasks by ranges of a numeric key and sort each task's rows.

    Adds ``bucket``, which is the number of the task. Rows of one key value stay together, so the
    key should identify a row; ``ties`` order rows that share one. Null keys come first.
    """
    cuts = cut_points(df.select(key), key, tasks or task_count(df))
    dealt = df.withColumn("bucket", bucket_of(F.col(key), cuts))
    count = len(cuts) + 1
    return dealt.repartitionById(count, "bucket").sortWithinPartitions("bucket", key, *ties), count


def running_starts(totals: DataFrame, value: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """``before``: the sum of ``value`` over earlier rows, for totals of tasks (few rows by nature)."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("before", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
