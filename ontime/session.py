"""Session settings, shared work folders and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Wide projections compile to one long method, and the JVM does not optimise methods above 8000 bytes.
# With this limit Spark takes its split-up code path for those stages instead, which runs several times faster.
WIDE_STAGES = {"spark.sql.codegen.hugeMethodLimit": "8000"}
# A write into folders otherwise sorts each task's whole rows by folder first; tasks that meet more folders still do.
FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "16"}

# Spark otherwise hands texts to Python 10,000 at a time, and up to 64 MB; each batch is held several times over, in the executor's and in
# the worker's memory, which keep what they once had. Small rows still go 10,000 at a time.
TEXT_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "1m"}

# Spark otherwise packs small files into one task, by their bytes on disk.
FILE_A_TASK = {"spark.sql.files.openCostInBytes": "1t"}


def local_session(cores: int | str = 8, app: str = "ontime") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ONTIME_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Test tables are small; keep them spread over the cores all the same.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in WIDE_STAGES.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ontime-"))
    return context.getCheckpointDir().rstrip("/")


def own_session(spark: SparkSession) -> SparkSession:
    """Another session of the same application with the same settings.

    A session that has observed a write holds an object that can't be sent to tasks, and closures of the machine-learning library
    send their session; so observing is done in a session that nothing else uses.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared work folder."""
    return f"{work_root(spark)}/ontime-{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute once and keep the rows in the shared work folder, so that lost executors cost nothing."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, label: str) -> DataFrame:
    """As ``durable``, but as a Parquet table, so that Spark knows its true size when it plans a join."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def kept_in_files(df: DataFrame, rows: int, label: str) -> DataFrame:
    """As ``kept``, in files of ``rows`` rows at most. Where jobs run under ``FILE_A_TASK`` no
    task gets more, however large the table."""
    path = fresh_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.parquet(path)


def kept_parts(df: DataFrame, by: str, parts: int, label: str) -> list[DataFrame]:
    """As ``kept``, in one job for several tables: the rows whose column ``by`` is 0, 1 and so on, without that column, each
    with a size of its own."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, label)
    df.write.partitionBy(by).parquet(path)
    layout = df.drop(by).schema
    out = []
    for i in range(parts):
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={i}")
        there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
        out.append(spark.read.schema(layout).parquet(place.toString()) if there else spark.createDataFrame([], layout))
    return out


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python are small in bytes from now on: plans read this when they run, which may be after the caller has returned. What
    the session has set itself stays."""
    for key, value in TEXT_BATCH.items():
        if key not in spark.conf.getAll:
            spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set SQL options for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
