"""Timing of micro-batches, from the engine's own progress events."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

_PROGRESS = "count long, elapsed double, rows_per_second double"


class TimingListener(StreamingQueryListener):
    """Writes every progress event to a table below ``path``; register with ``spark.streams``.

    A row is keyed by query, run and batch, so concurrent queries and restarts
    stay apart, an event that comes twice replaces itself, and nothing is kept
    in the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = [(p.numInputRows, p.batchDuration / 1000.0, p.processedRowsPerSecond)]
        place = f"{self.path}/query_id={p.id}/run_id={p.runId}/batch_id={p.batchId}"
        self.spark.createDataFrame(row, _PROGRESS).write.mode("overwrite").parquet(place)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until all events of a run that has ended are written."""
        return self._end_of(str(query.runId)).wait(seconds)


def batch_timing(spark: SparkSession, path: str, query_id: str | None = None) -> DataFrame:
    """(query_id, run_id, batch_id, metric, value) rows of every micro-batch, or of one query's.

    Latency is elapsed time per row, null for an empty batch.
    """
    rows = spark.read.parquet(path)
    if query_id:
        rows = rows.where(F.col("query_id") == query_id)
    measured = rows.select(
        "query_id",
        "run_id",
        "batch_id",
        F.col("count").cast("double").alias("count"),
        "elapsed",
        F.try_divide("elapsed", "count").alias("latency"),
        "rows_per_second",
    )
    keys = ["query_id", "run_id", "batch_id"]
    return measured.unpivot(keys, ["count", "elapsed", "latency", "rows_per_second"], "metric", "value")
