"""Streaming counters and progress (AG6, UDF3).

``observed_counts`` attaches named counters to a streaming DataFrame with
``DataFrame.observe``; Spark aggregates them per micro-batch on the executors
and reports them in the query progress.  ``ProgressRecorder`` is a
``StreamingQueryListener`` that adds up the progress of a query, the
stream-side equivalent of the reference's delivery callback.  Counters that must
survive the driver are committed with each batch (:func:`logweave.streaming.sinks.counters`).
"""

from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed_counts(df: DataFrame, name: str, counters: dict[str, Column]) -> DataFrame:
    """Per-batch counters, e.g. ``{"ok": F.count_if(F.col("error").isNull())}``."""
    return df.observe(name, *[c.alias(k) for k, c in counters.items()])


def dlq_counters(classified: DataFrame, name: str = "dlq") -> DataFrame:
    err = F.col("error")
    return observed_counts(classified, name, {
        "ok": F.count_if(err.isNull()),
        "routed": F.count_if(err.isNotNull()),
        "recoverable": F.count_if(F.coalesce(err.startswith("missing_fields"), F.lit(False))),
    })


class ProgressRecorder(StreamingQueryListener):
    """Collects progress events (input rows, rates, observed metrics): totals of all, and
    the last ``keep`` events."""

    def __init__(self, keep: int = 1000) -> None:
        self._lock = threading.Lock()
        self.progress: deque[dict] = deque(maxlen=keep)
        self._rows = self._ms = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        obs = {k: v.asDict() for k, v in (p.observedMetrics or {}).items()}
        ms = p.durationMs.get("triggerExecution", 0)
        with self._lock:
            self._rows += p.numInputRows
            self._ms += ms
            self.progress.append({"id": str(p.id), "batch": p.batchId, "rows": p.numInputRows,
                                  "duration_ms": ms, "observed": obs})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def rows_per_second(self) -> float:
        """Input rows over trigger time, all batches recorded so far."""
        with self._lock:
            return self._rows / (self._ms / 1000.0) if self._ms else 0.0
