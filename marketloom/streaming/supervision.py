"""Supervision of a layer's queries: their progress as a table, and an end when one of them fails."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query string, run_id string, batch_id bigint, at timestamp, input_rows bigint, state_rows bigint, "
    "rows_dropped_late bigint, watermark timestamp, batch_ms bigint, error string"
)
#: Progress rows that wait for a write at most.
KEPT = 500
#: Seconds between two looks at the states of the other queries.
POLL = 0.5


def _instant(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressLog(StreamingQueryListener):
    """Writes a row per micro-batch and per ended query of a session to a table, some at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows, self.lock = spark, path, [], threading.Lock()
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._add((
            p.name, str(p.runId), p.batchId, _instant(p.timestamp), p.numInputRows,
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            _instant(p.eventTime.get("watermark")), p.batchDuration, None,
        ))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        name = self.names.pop(str(event.runId), None)
        self._add((name, str(event.runId), None, None, None, None, None, None, None, event.exception))

    def _add(self, row: tuple) -> None:
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= KEPT
        if full:
            self.flush()

    def flush(self) -> None:
        """Append the waiting rows to the table."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)


@contextmanager
def progress_kept(spark: SparkSession, path: str | None) -> Iterator[None]:
    """Inside, the progress of all queries of the session goes to the table at ``path``, if given."""
    if path is None:
        yield
        return
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield
    finally:
        # Events are delivered by a bus of their own; what it has not delivered yet is waited for.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        spark.streams.removeListener(log)
        log.flush()


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The kept progress: a row per micro-batch, and one with ``error`` per query that failed."""
    return spark.read.schema(PROGRESS).parquet(path)


def supervise(queries: Iterable[StreamingQuery], *, bounded: bool) -> None:
    """Wait until all queries of a bounded run have ended, else until the first one has.

    The error of a failed query is raised as soon as it fails, and the other queries are stopped.
    """
    queries = list(queries)
    try:
        while True:
            ended = [query for query in queries if not query.isActive]
            for query in ended:
                if error := query.exception():
                    raise error
            if len(ended) == len(queries) or (ended and not bounded):
                return
            next(query for query in queries if query not in ended).awaitTermination(POLL)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
