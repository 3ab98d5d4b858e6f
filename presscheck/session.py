"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folders that a feed's batch has stored so far.
_stored: ContextVar[list[str]] = ContextVar("stored")


def builder(app_name: str = "presscheck") -> SparkSession.Builder:
    """Defaults for article tables: rows are long texts, up to 100,000 characters.

    The Arrow batch is bounded in bytes as well as rows, so a worker never holds
    thousands of long texts at once. Partition counts are left to AQE.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    )


def _shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # One machine, as in tests: any folder is shared.
    folder = tempfile.mkdtemp(prefix="presscheck-")
    context.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{_shared_folder(spark)}/presscheck-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder that all executors share."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes what this application has stored. Frames that read it are of no use afterwards."""
    _delete(spark, _own_folder(spark))


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what :func:`materialise` has stored within, as after a batch of a feed."""
    stored: list[str] = []
    token = _stored.set(stored)
    try:
        yield
    finally:
        _stored.reset(token)
        for path in stored:
            _delete(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back.

    The copy outlives lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _stored.get([]).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """Shuffles a freshly read table by key if its files are too few for the cluster.

    A table of many files keeps its scan partitions, so nothing moves at scale.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, *keys)
