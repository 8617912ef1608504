"""G5 for streams: what each micro-batch observed, as rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class BatchCounters(StreamingQueryListener):
    """Collects the named ``observe`` metrics of streaming queries, one entry per batch and metric.

    Use as a context around the query's run; it holds a few numbers per batch.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._rows, self._ended = spark, [], {}
        self._lock = threading.Lock()

    def __enter__(self) -> BatchCounters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            for counter, value in row.asDict().items():
                self._rows.append((str(p.id), int(p.batchId), name, counter, int(value)))

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def finish(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Wait for the query's end, and for its last events, which arrive on another thread."""
        query.awaitTermination()
        self._end(str(query.runId)).wait(timeout)

    def table(self) -> DataFrame:
        """``query, batch, name, counter, value``."""
        return self.spark.createDataFrame(sorted(set(self._rows)), "query string, batch bigint, name string, counter string, value bigint")
