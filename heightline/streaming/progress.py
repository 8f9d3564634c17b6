"""How a running stream is doing."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_DDL = "batch_id BIGINT, input_rows BIGINT, rows_per_second DOUBLE, duration_ms BIGINT"
UPDATE_DDL = f"query STRING, run STRING, at STRING, {PROGRESS_DDL}"


def _figures(update: dict) -> tuple:
    return (
        update["batchId"],
        update["numInputRows"],
        float(update.get("processedRowsPerSecond") or 0.0),
        update.get("durationMs", {}).get("triggerExecution", 0),
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch.

    Spark itself keeps only the last few (see
    ``spark.sql.streaming.numRecentProgressUpdates``); ``ProgressLog`` keeps all.
    """
    rows = [_figures(json.loads(u.json) if hasattr(u, "json") else u) for u in query.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_DDL)


class ProgressLog(StreamingQueryListener):
    """Appends each update of the session's streams to a table, as it comes.

    ``with ProgressLog(spark, path) as log`` listens inside the block. Spark
    hands updates over after the batch, on a thread of its own; ``wait`` returns
    once those of a query that has ended are in the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        update = json.loads(event.progress.json)
        row = (update["id"], update["runId"], update["timestamp"], *_figures(update))
        self.spark.createDataFrame([row], UPDATE_DDL).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Whether all updates of a query that has ended are written, within so many seconds."""
        return self._end(str(query.runId)).wait(seconds)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(UPDATE_DDL).parquet(self.path)
