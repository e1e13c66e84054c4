"""Per-query stream health from progress events.

A ``StreamingQueryListener`` adds every progress event to one running total per
query name, so its memory does not grow with the number of micro-batches; the
``recentProgress`` buffer of a query only keeps the last few.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

HEALTH_SCHEMA = ("query_name string, batches long, rows_in long, state_rows long, "
                 "rows_dropped_by_watermark long, duplicate_rows_dropped long, last_batch_time string")


class StreamHealth(StreamingQueryListener):
    """Totals over the progress of every streaming query of a session."""

    def __init__(self):
        self._lock = threading.Lock()
        self.totals: dict[str, list] = {}
        self.observed: dict[str, dict[str, int]] = {}
        self.running: set[str] = set()

    def onQueryStarted(self, event):  # noqa: N802 (Spark listener API)
        with self._lock:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        state_rows = dropped = dups = 0
        for op in p.stateOperators or []:
            state_rows += op.numRowsTotal or 0
            dropped += op.numRowsDroppedByWatermark or 0
            dups += (op.customMetrics or {}).get("numDroppedDuplicateRows", 0) or 0
        with self._lock:
            t = self.totals.setdefault(p.name, [0, 0, 0, 0, 0, ""])
            t[0] += 1
            t[1] += int(p.numInputRows or 0)
            t[2] = int(state_rows)
            t[3] += int(dropped)
            t[4] += int(dups)
            t[5] = max(t[5], p.timestamp)
            # counts that ``operators.observed.observe_stream`` took along
            for name, row in (p.observedMetrics or {}).items():
                sums = self.observed.setdefault(name, {})
                for metric, n in row.asDict().items():
                    sums[metric] = sums.get(metric, 0) + int(n or 0)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        with self._lock:
            self.running.discard(str(event.runId))

    def attach(self, spark: SparkSession) -> "StreamHealth":
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession, timeout: float = 60) -> None:
        """Stop listening once every query that started has reported its end: events are
        asynchronous and arrive in order, so none of its progress is missing then."""
        end = time.time() + timeout
        while time.time() < end:
            with self._lock:
                if not self.running:
                    break
            time.sleep(0.05)
        spark.streams.removeListener(self)

    def report(self, spark: SparkSession) -> DataFrame:
        """Per query: batches, rows in, current state rows, rows dropped by
        the watermark, duplicates dropped, last batch time."""
        with self._lock:
            rows = [(name, *t) for name, t in self.totals.items()]
        return spark.createDataFrame(rows, HEALTH_SCHEMA).orderBy("query_name")
