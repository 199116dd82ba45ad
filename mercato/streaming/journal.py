"""A lasting record of every micro-batch.

``recentProgress`` keeps the last hundred batches of a running query. The
journal listens to the progress events instead and appends them to a table
while the query runs, so a stream of any length is recorded whole and the
driver holds only the events since the last flush.
"""

from __future__ import annotations

import threading
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query_id string, batch_id long, input_rows long, dropped_by_watermark long, watermark string, duration_ms long"


class BatchJournal(StreamingQueryListener):
    """Appends a row per executed micro-batch of the followed queries to ``path``.

    ``dropped_by_watermark`` counts what the state operators found behind the
    watermark: rows of the partial aggregate, so several late events of one
    window, code and task may count once (:mod:`mercato.streaming.late` has the events)."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._lock, self._pending = threading.Lock(), []
        self._ended: set[str] = set()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        row = (str(p.id), p.batchId, p.numInputRows, dropped, p.eventTime.get("watermark"), p.durationMs.get("triggerExecution", 0))
        with self._lock:
            self._pending.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))

    def flush(self) -> None:
        """Write the events so far; called by the waiting thread, never by the listener's."""
        with self._lock:
            rows, self._pending = self._pending, []
        if rows:
            self._spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self._path)

    def close(self, query: StreamingQuery | None = None, timeout_s: float = 60) -> None:
        """Take the last events of an ended query, write them and stop listening."""
        limit = time.monotonic() + timeout_s
        while query is not None and str(query.runId) not in self._ended and time.monotonic() < limit:
            time.sleep(0.05)
        self._spark.streams.removeListener(self)
        self.flush()


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """A row per query and batch; a batch that was replayed counts once."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    values = [F.max(c).alias(c) for c in ("input_rows", "dropped_by_watermark", "watermark", "duration_ms")]
    return rows.groupBy("query_id", "batch_id").agg(*values)


def last_watermark(spark: SparkSession, path: str) -> str | None:
    """The event time before which the recorded batches can change no window any more."""
    return read_journal(spark, path).agg(F.max("watermark")).first()[0]
