"""File and table input and output."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.config import RAW_SCHEMA
from riskloom.operators.ingest import new_rows, stamp, without_copies
from riskloom.operators.quality import key_check
from riskloom.session import stored

#: Keys of a batch that the driver takes and pushes into the scan of the target, at most.
PUSHED_KEYS = 2000


def read_csv(spark: SparkSession, path: str, schema: StructType | None = RAW_SCHEMA) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file once more to infer one."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of records, or a CSV whose values stay strings."""
    suffix = PurePath(path).suffix.lower()
    if suffix == ".json":
        return spark.read.option("multiLine", True).json(path)
    if suffix == ".csv":
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"a fixture is a .json or .csv file, not {path}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def merge_into_table(
    source: DataFrame,
    name: str,
    key: str = "row_hash",
    dedupe_source: bool = False,
    buckets: int | None = None,
) -> str:
    """Create the table from ``source``, or append the rows whose key it lacks.

    ``buckets`` stores a new table bucketed by the key, so that later merges do not shuffle it. Its files carry Bloom
    filters of the key, and rows are sorted by it within a file. A batch of at most ``PUSHED_KEYS`` keys is looked up
    by these: Spark's scan gets the keys and leaves out the row groups that have none of them. A larger batch has keys
    in most row groups, so the key column is read as a whole. Returns 'created' or 'merged'. One writer at a time: plain
    tables have no transactions.
    """
    spark = source.sparkSession
    if not spark.catalog.tableExists(name):
        first = without_copies(source, key) if dedupe_source else source
        # The options are kept with the table and hold for what is appended later.
        writer = first.sortWithinPartitions(key).write.mode("overwrite").options(**key_filters(key))
        (writer.bucketBy(buckets, key).sortBy(key) if buckets else writer).saveAsTable(name)
        return "created"
    target, rows = spark.table(name), stored(source)
    with few_keys(rows, key) as keys:
        seen = target if keys is None else target.filter(F.col(key).isin(keys))
        fresh = new_rows(seen, rows, key, dedupe_source).select(*target.columns)
        fresh.sortWithinPartitions(key).write.mode("append").insertInto(name)
    return "merged"


def key_filters(key: str) -> dict[str, str]:
    """Options under which Parquet files carry Bloom filters of a column, as large as its values need."""
    return {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session inside the block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def few_keys(rows: DataFrame, key: str) -> Iterator[list | None]:
    """The distinct keys of a batch if they are few, for a filter that is pushed into scans inside the block; else None."""
    found = rows.filter(F.col(key).isNotNull()).select(key).distinct().limit(PUSHED_KEYS + 1).collect()
    with setting(rows.sparkSession, "spark.sql.parquet.pushdown.inFilterThreshold", PUSHED_KEYS):
        yield [r[0] for r in found] if len(found) <= PUSHED_KEYS else None


def ingest_csv(
    spark: SparkSession,
    path: str,
    name: str,
    batch_id: str = "manual",
    schema: StructType | None = RAW_SCHEMA,
    ingest_ts: datetime | None = None,
    safe_hash: bool = False,
    dedupe_source: bool = False,
) -> str:
    """A CSV file into the bronze table; loading a file again adds nothing."""
    raw = read_csv(spark, path, schema)
    return merge_into_table(stamp(raw, batch_id, ingest_ts, safe=safe_hash), name, dedupe_source=dedupe_source)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace the table's rows and its schema."""
    df.write.mode("overwrite").saveAsTable(name)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append to a log table, matching columns by name; creates the table when it is missing."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = df.select(*spark.table(name).columns)
        df.write.mode("append").insertInto(name)
    else:
        df.write.saveAsTable(name)


def append_by_day(df: DataFrame, name: str, ts: str = "request_ts") -> None:
    """``append_by_name`` to a log with a folder a day: column ``request_date`` is added and readers can filter by it."""
    spark = df.sparkSession
    df = df.withColumn("request_date", F.to_date(ts))
    if spark.catalog.tableExists(name):
        append_by_name(df, name)
    else:
        # One task a day and not every day in every task: a file a day.
        df.repartition("request_date").write.partitionBy("request_date").saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, partition: str) -> None:
    """Replace the partitions that the frame has rows of, and leave all others as they are."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.partitionBy(partition).saveAsTable(name)
        return
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)


def proven(df: DataFrame, name: str, key: str) -> DataFrame:
    """The rows written aside, with ``key`` as their primary key; an error if it is none."""
    aside = stored(df)
    check = key_check(aside, key).first()
    if not check["is_primary_key"]:
        raise ValueError(f"{key} is not a primary key of {name}: {check.asDict()}")
    return aside


def publish_feature_table(df: DataFrame, name: str, key: str, description: str) -> DataFrame:
    """Prove the key of a feature table, then publish it. Returns the table.

    The rows are written aside first, so a table that fails the check never replaces the published one.
    """
    return publish_all({name: df}, key, description)[name]


def publish_all(frames: Mapping[str, DataFrame], key: str, description: str) -> dict[str, DataFrame]:
    """Publish feature tables that belong together: all are computed and proven before the first is replaced."""
    aside = {name: proven(df, name, key) for name, df in frames.items()}
    out = {}
    for name, rows in aside.items():
        overwrite_table(rows, name)
        spark = rows.sparkSession
        text = f"{description} ({name})" if len(aside) > 1 else description
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = :text)", args={"text": text})
        out[name] = spark.table(name)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """A CSV folder with a header in every part."""
    df.write.mode("overwrite").option("header", True).csv(path)

