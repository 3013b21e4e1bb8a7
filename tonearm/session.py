"""Session settings and the shared folder for lineage cuts and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tonearm", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC time.

    On a cluster ``master`` and the shuffle width come from spark-submit; AQE
    coalesces the wide initial partitioning down to what the data needs.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only where neither the setting nor the context has one (a local test) is a
    temporary folder used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="tonearm-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


# Hadoop's local file system, and Hive's name for it where Spark comes with Hive.
_LOCAL = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it, or None where it is on another file system than the plain local one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    where = system.makeQualified(hadoop).toUri()
    return where.getPath() if where.getScheme() == "file" and system.getClass().getName() in _LOCAL else None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/tonearm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read back.

    Cuts lineage like a checkpoint and survives lost executors. The table also
    brings its true size: the estimate of a checkpointed frame is that of its
    plan, which grows with every join of an iterative job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def listing_of_small_files(spark: SparkSession) -> Iterator[None]:
    """Folders listed within are dealt to a few tasks a core in place of up to 10,000, and nobody asks where the files lie.

    A listing returns a row per file to the driver; where a file of some lines lies would be the larger part of it.
    """
    wanted = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": 4 * spark.sparkContext.defaultParallelism,
        "spark.sql.sources.ignoreDataLocality": "true",
    }
    given = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in given.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def arrow_batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run within hand at most ``rows`` rows at once to Python; the session's setting is as before afterwards.

    A batch of whole texts stands in memory several times: as Arrow on both sides, and as Python's strings.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given, now = spark.conf.get(key, None), int(spark.conf.get(key))
    spark.conf.set(key, min(rows, now) if now > 0 else rows)
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, given)


def discard(*frames: DataFrame) -> None:
    """Delete the staged tables that the frames read.

    For frames whose readers are all written: a task that runs again could not read the tables any more. Only
    folders that ``staged`` made in the shared folder go; other tables of a frame stay.
    """
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getName().startswith("tonearm-"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
