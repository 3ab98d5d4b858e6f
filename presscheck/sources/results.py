"""Result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCORED, REJECTED = "scored", "rejected"


def write_results(
    results: DataFrame,
    path: str,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    rebalance: bool = True,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Writes scored and rejected rows to two partitions of one table in one pass.

    Results are far smaller than the texts they come from, so a scan of many files
    would leave tiny ones behind. Rebalancing lets AQE gather them to full files.
    ``watch`` may observe the rows in the stage that writes them, which counts each once.
    """
    if rebalance:
        results = results.hint("rebalance")
    watch(results).write.mode(mode).partitionBy("outcome").format(fmt).save(path)


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """One outcome; the other's files are not opened."""
    return spark.read.parquet(path).where(F.col("outcome") == outcome)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return read_outcome(spark, path, SCORED).drop("outcome", "code", "reason")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return read_outcome(spark, path, REJECTED).drop("outcome", "input", "models", "final")
