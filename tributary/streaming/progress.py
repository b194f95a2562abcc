"""Supervision of running queries (T4, T9): what each micro-batch did, and what failed."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

#: Micro-batches remembered; older ones leave (their totals stay).
KEEP = 10_000


class Batch(NamedTuple):
    query: str
    batch_id: int
    n_rows: int
    n_late: int
    milliseconds: int


class Progress(StreamingQueryListener):
    """Rows, late rows and duration of every micro-batch of the session's queries, by the
    query's name (its id if it has none), and the errors of those that failed.

    Register with ``spark.streams.addListener``.  Events come from another thread, shortly
    after the batch; ``seen`` waits for those of a query's last batch."""

    def __init__(self, keep: int = KEEP):
        self._changed = threading.Condition()
        self.batches: deque[Batch] = deque(maxlen=keep)
        self.rows: dict[str, int] = {}
        self.last: dict[str, int] = {}
        self.failures: dict[str, str] = {}
        self._names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        with self._changed:
            self.batches.append(Batch(name, p.batchId, p.numInputRows, late, p.batchDuration))
            self.rows[name] = self.rows.get(name, 0) + p.numInputRows
            self.last[name] = p.batchId
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            with self._changed:
                self.failures[self._names.get(str(event.id), str(event.id))] = event.exception
                self._changed.notify_all()

    def seen(self, query: StreamingQuery, timeout: float = 60.0) -> int:
        """Rows of the query so far, its last finished batch included."""
        name, last = query.name or str(query.id), query.lastProgress
        if last is None:
            return 0
        with self._changed:
            if not self._changed.wait_for(lambda: self.last.get(name, -1) >= last["batchId"], timeout):
                raise TimeoutError(f"{name}: no progress event of batch {last['batchId']}")
            return self.rows[name]


def supervise(queries: Sequence[StreamingQuery], poll: float = 1.0) -> None:
    """Block until any of the queries ends; the others are stopped then, and the error of one
    that failed is raised.  Only these queries count, not others of the session."""
    try:
        while True:
            for query in queries:
                if not query.isActive:
                    query.awaitTermination()  # raises what it failed with
                    return
            time.sleep(poll)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
