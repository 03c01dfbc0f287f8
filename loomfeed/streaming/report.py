"""Row counts of every micro-batch, observed while it runs."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class BatchReports(StreamingQueryListener):
    """Gathers what ``DataFrame.observe(name, ...)`` counted in each batch of the session's queries.

    Used as a context: listening ends with it. Nothing is counted twice over the
    data, the figures come with the progress of the query.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._name = spark, name
        self._counts: dict[str, dict[int, dict[str, int]]] = defaultdict(dict)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> BatchReports:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self._name)
        if found is not None:
            self._counts[str(event.progress.runId)][event.progress.batchId] = found.asDict()

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def of(self, query: StreamingQuery, timeout: float = 60) -> dict[int, dict[str, int]]:
        """The counts of an ended query by batch id."""
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError("the query has not ended")
        return dict(sorted(self._counts[str(query.runId)].items()))
