"""Session defaults for local runs, and the checkpoint folder of a cluster session."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_paths: list[str] = []


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the bench. On a cluster, bring your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a folder in the warehouse.

    The warehouse is shared on a cluster too, so there is one way for every kind of session.
    """
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    return spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_intermediate")


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The frame, written once as Parquet in the shared folder and read back.

    For frames that several passes read: later passes read the columns they need instead of
    computing everything again, and a lost executor costs no recomputation. ``partition_by`` is
    a column of few values by which later passes filter; they then skip the other files.
    ``release_stored`` deletes the files once no frame built on them is needed.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    _paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


class TemporaryTables:
    """Stored frames that go when the block ends, or before that one by one.

    For loops that store a new state a round. Frames stored by others, in this block or elsewhere, stay.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{shared_folder(self._spark)}/stored-{uuid4().hex}"
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def drop_all_but_last(self) -> None:
        """Delete every frame but the one stored last."""
        while len(self._paths) > 1:
            _delete(self._spark, self._paths.pop(0))

    def __enter__(self) -> TemporaryTables:
        return self

    def __exit__(self, *_) -> None:
        while self._paths:
            _delete(self._spark, self._paths.pop())


def _delete(spark: SparkSession, address: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_stored(spark: SparkSession) -> int:
    """Delete every stored frame of this driver; the number of folders deleted."""
    released = 0
    while _paths:
        released += _delete(spark, _paths.pop())
    return released
