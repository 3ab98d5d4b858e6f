"""Scoring a feed of articles as it arrives."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from presscheck.operators.scorers import Scorer
from presscheck.operators.verdict_store import VerdictStore
from presscheck.plans.scoring import require_forest, run_counts, score_articles, score_articles_once
from presscheck.session import passing_tables

METRICS_NAME = "presscheck_run"
COUNTS = ("rows_in", "rows_rejected", "rows_scored", "contract_violations", "rows_fallback")
BATCH_SCHEMA = ", ".join(f"{c} long" for c in COUNTS) + ", seconds double, ended timestamp"


class FeedMetrics(StreamingQueryListener):
    """Stores one row of run metrics for each batch of a named query.

    A batch has a folder of its own, which is overwritten, so a batch that is run again after
    a restart counts once.
    """

    def __init__(self, spark: SparkSession, path: str, query_name: str):
        self.spark, self.path, self.query_name = spark, path, query_name
        self.run_id, self.ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = (progress.observedMetrics or {}).get(METRICS_NAME)
        # A trigger without new files repeats no batch and has nothing to count.
        if progress.name == self.query_name and counted is not None and counted.rows_in:
            store_batch(self.spark, self.path, progress.batchId, counted, progress.batchDuration / 1000.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()


def store_batch(spark: SparkSession, path: str, batch: int, counted, seconds: float) -> None:
    row = (*[int(counted[c]) for c in COUNTS], seconds)
    frame = spark.createDataFrame([row], BATCH_SCHEMA.rpartition(",")[0]).withColumn("ended", F.current_timestamp())
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row of metrics for each batch, with its number in ``batch``."""
    return spark.read.schema(f"{BATCH_SCHEMA}, batch long").parquet(path)


def missing_batches(metrics: DataFrame) -> DataFrame:
    """Numbers up to the last batch that have no row.

    Batches count up from 0, so these are batches without rows, or such whose driver died
    between the batch's end and its metrics.
    """
    last = metrics.agg(F.max("batch").alias("last"))
    numbers = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("batch"))
    return numbers.join(metrics.select("batch"), "batch", "left_anti")


_listeners: dict[str, FeedMetrics] = {}


def start_feed(
    articles: DataFrame,
    keys: list[str],
    path: str,
    checkpoint: str,
    first: Scorer,
    second: Scorer,
    trigger: dict | None = None,
    metrics: str | None = None,
) -> StreamingQuery:
    """Scores a streaming frame with the batch operators and appends to ``path``.

    Scored and rejected rows go to two partitions of one file sink, which records
    each batch once, so a restart neither drops nor repeats rows. Records are
    independent; there is no state. Counters appear in the query's progress, and with
    ``metrics``, a folder, as one stored row for each batch.
    """
    results = score_articles(articles, keys, first, second).observe(METRICS_NAME, *run_counts())
    writer = (
        results.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if metrics is None:
        return writer.start()
    spark = articles.sparkSession
    listener = FeedMetrics(spark, metrics, f"presscheck-{uuid.uuid4().hex}")
    spark.streams.addListener(listener)
    query = writer.queryName(listener.query_name).start()
    _listeners[query.runId] = listener
    return query


def await_feed(query: StreamingQuery, timeout: float = 60.0) -> None:
    """Waits for the end of a feed and of its metrics, which come after it."""
    try:
        query.awaitTermination()
    finally:
        listener = _listeners.pop(query.runId, None)
        if listener is not None:
            if not listener.ended.wait(timeout):
                raise TimeoutError("the metrics of the feed have not arrived")
            listener.spark.streams.removeListener(listener)


def start_feed_once(
    articles: DataFrame,
    keys: list[str],
    path: str,
    checkpoint: str,
    first: Scorer,
    second: Scorer,
    known: str,
    trigger: dict | None = None,
    metrics: str | None = None,
) -> StreamingQuery:
    """:func:`start_feed`, but a text that any earlier batch has scored is not scored again.

    ``known`` is a folder for the verdicts, see ``VerdictStore``. Each batch overwrites its own
    folder under ``path``, under ``known`` and under ``metrics``, so a batch that is run again
    counts once. The results have the number of the batch beside their columns.
    """
    require_forest(first)

    def run(rows: DataFrame, batch: int) -> None:
        spark, started, observation = rows.sparkSession, time.monotonic(), Observation()
        with passing_tables(spark):
            store = VerdictStore(spark, known, batch)
            results = score_articles_once(rows, keys, first, second, store=store).observe(observation, *run_counts())
            results.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch={batch}")
            if metrics is not None:
                counted = observation.get
                store_batch(spark, metrics, batch, counted, time.monotonic() - started)

    return (
        articles.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
