"""What a running query says of itself: records of each micro-batch, and a stop when no more come.

A listener is told by events; nothing sleeps, and no progress is lost because a query keeps only its last ones.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from skytally.streaming.runner import BatchSink, start

_QUIET = "spark.sql.streaming.noDataProgressEventInterval"
BATCHES = "batch_id BIGINT, records BIGINT"


class StreamLog(StreamingQueryListener):
    """The batches of the queries of a session, and a sign when one of them has been idle.

    A query says that it is idle when it has looked for input and found none, at most once in ``quiet_seconds``; it says
    nothing while a batch runs, however long that takes. After ``idle_events`` such events in a row the sign is given.
    """

    def __init__(self, idle_events: int = 2):
        self.idle_events = idle_events
        self.batches: dict[str, dict[int, int]] = {}
        self.quiet: dict[str, int] = {}
        self.signs: dict[str, threading.Event] = {}
        self.ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _of(self, known: dict[str, threading.Event], run: str) -> threading.Event:
        with self._lock:
            return known.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._of(self.signs, str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = str(progress.runId)
        if progress.numInputRows:
            self.quiet[run] = 0
            self.batches.setdefault(run, {})[progress.batchId] = progress.numInputRows

    def onQueryIdle(self, event) -> None:
        run = str(event.runId)
        self.quiet[run] = self.quiet.get(run, 0) + 1
        if self.quiet[run] >= self.idle_events:
            self._of(self.signs, run).set()

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._of(self.signs, run).set()  # whoever waits for idleness need not wait for it any longer
        self._of(self.ended, run).set()

    def wait_until_idle(self, run: str, timeout: float | None = None) -> bool:
        return self._of(self.signs, run).wait(timeout)

    def records(self, spark: SparkSession, run: str, timeout: float | None = 60.0) -> DataFrame:
        """``(batch_id, records)`` of a query that has ended; a batch without records is not listed."""
        self._of(self.ended, run).wait(timeout)  # events come after the query's own end
        return spark.createDataFrame(sorted(self.batches.get(run, {}).items()), BATCHES)


def run_logged(stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "update") -> DataFrame:
    """Run over all input that is there; returns ``(batch_id, records)``."""
    spark, log = stream.sparkSession, StreamLog()
    spark.streams.addListener(log)
    try:
        query = start(stream, sink, checkpoint, mode)
        query.awaitTermination()
        return log.records(spark, str(query.runId))
    finally:
        spark.streams.removeListener(log)


def run_until_idle(
    stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "update", interval: str = "1 second",
    quiet_seconds: float = 40.0, idle_events: int = 2, timeout: float | None = None,
) -> DataFrame:
    """Run a continuous query until it has said ``idle_events`` times in a row, ``quiet_seconds`` apart, that there is
    no input; returns ``(batch_id, records)``. With ``timeout`` (seconds) it ends then at the latest."""
    spark, log = stream.sparkSession, StreamLog(idle_events)
    before = spark.conf.get(_QUIET)
    spark.conf.set(_QUIET, str(int(quiet_seconds * 1000)))
    spark.streams.addListener(log)
    try:
        query = start(stream, sink, checkpoint, mode, interval)
        log.wait_until_idle(str(query.runId), timeout)
        query.stop()
        query.awaitTermination()  # raises what the query failed with
        return log.records(spark, str(query.runId))
    finally:
        spark.streams.removeListener(log)
        spark.conf.set(_QUIET, before)
