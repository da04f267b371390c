"""Ends a standing stream after so many rows, or when nothing has come for a while."""

from __future__ import annotations

import threading
import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class _Watch(StreamingQueryListener):
    """Rows of one query by micro-batch, and the time of the last ones."""

    def __init__(self, query: StreamingQuery):
        self._id, self.taken, self.last, self.changed = query.runId, {}, time.monotonic(), threading.Event()

    @property
    def rows(self) -> int:
        return sum(self.taken.values())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == str(self._id):
            if event.progress.numInputRows:
                self.taken[event.progress.batchId] = event.progress.numInputRows
                self.last = time.monotonic()
            self.changed.set()

    def onQueryIdle(self, event) -> None:
        if str(event.runId) == str(self._id):
            self.changed.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == str(self._id):
            self.changed.set()


def run_until(query: StreamingQuery, rows: int | None = None, idle: float | None = None) -> int:
    """Let a query run until it has taken ``rows`` rows, or no row for ``idle`` seconds, or has ended by itself; stop it and give the
    rows taken. Micro-batches are whole, so more rows than asked for may have been taken. An error of the query is raised."""
    if rows is None and idle is None:
        raise ValueError("say after how many rows or after what idle time to stop")
    watch, streams = _Watch(query), SparkSession.active().streams
    streams.addListener(watch)
    # Batches that ended before the listener was there.
    for p in query.recentProgress:
        if p.numInputRows:
            watch.taken.setdefault(p.batchId, p.numInputRows)
    try:
        while query.isActive:
            if rows is not None and watch.rows >= rows:
                break
            if idle is not None and time.monotonic() - watch.last >= idle and not query.status["isTriggerActive"]:
                break
            watch.changed.wait(0.2)
            watch.changed.clear()
        query.stop()
    finally:
        streams.removeListener(watch)
    if query.exception() is not None:
        raise query.exception()
    return watch.rows
