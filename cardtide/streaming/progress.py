"""Rows of each micro-batch of the streams of a session: in, out and too late."""

from __future__ import annotations

import datetime as dt
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from cardtide.streaming.jobs import ROWS_OUT

BATCHES = (
    "query string, batch_id long, at timestamp, rows_in long, rows_out long, rows_late long"
)


class BatchLog(StreamingQueryListener):
    """Keeps one row per micro-batch that read or wrote something.

    ``query`` is the stream's name, or its id if it has none. ``rows_out`` is what the library's
    streams hand to their sink, null for others. ``rows_late`` counts what stateful steps left
    out as behind the watermark; behind an aggregation that is groups of rows, as they are added up in
    each task first. With ``path`` every ``every`` batches are added to a table there, and the rest
    on ``save``; without, the newest ``keep`` stay in memory.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, every: int = 600, keep: int = 100_000
    ):
        self.spark, self.path, self.every = spark, path, every
        self._rows: deque[tuple] = deque(maxlen=None if path else keep)
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(ROWS_OUT)
        late = sum(step.numRowsDroppedByWatermark for step in progress.stateOperators)
        rows_out = observed["n"] if observed is not None else None
        if not (progress.numInputRows or rows_out or late):
            return
        at = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        name = progress.name or str(progress.id)
        with self._lock:
            self._rows.append((name, progress.batchId, at, progress.numInputRows, rows_out, late))
            full = self.path is not None and len(self._rows) >= self.every
        if full:
            self.save()

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait until the last batch of an ended query is in; events come with a delay."""
        if not self._end_of(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of query {query.id} seen in {timeout} s")

    def save(self) -> None:
        """Add what has been gathered to the table at ``path``."""
        if self.path is None:
            raise ValueError("this log has no path")
        with self._lock:
            rows = list(self._rows)
            self._rows.clear()
        if rows:
            table = self.spark.createDataFrame(rows, BATCHES).coalesce(1)
            table.write.mode("append").parquet(self.path)

    def batches(self) -> DataFrame:
        """The rows, from the table if there is one."""
        if self.path is not None:
            self.save()
            return self.spark.read.schema(BATCHES).parquet(self.path)
        with self._lock:
            return self.spark.createDataFrame(list(self._rows), BATCHES)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
