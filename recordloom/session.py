"""Session helpers: builder defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "recordloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect; callers may override any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # The other form of instants in Parquet has no statistics, so no range could skip a row group.
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        # Call sites per Column cost a gateway round trip each; plans here have thousands of Columns.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="recordloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write in here go when it ends, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, wherever the shared folder is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor and is computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
