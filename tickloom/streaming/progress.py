"""Progress reports of streaming queries as a table."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.sources.envelopes import read_or_empty

PROGRESS = (
    "query STRING, batch_id BIGINT, input_rows BIGINT, input_rate DOUBLE, process_rate DOUBLE, "
    "batch_ms BIGINT, watermark STRING, state_rows BIGINT, state_bytes BIGINT, "
    "dropped_by_watermark BIGINT, observed MAP<STRING, BIGINT>"
)


class ProgressLog(StreamingQueryListener):
    """Appends every report of a session's queries to a table.

    A query itself only remembers its last reports
    (``spark.sql.streaming.numRecentProgressUpdates``), so sums over a long run need this log. Reports
    are held until there are ``flush_every`` of them or a query ends, then written as one file.
    Attach it before the queries start::

        log = ProgressLog(spark, uri)
        spark.streams.addListener(log)
    """

    def __init__(self, spark: SparkSession, uri: str, flush_every: int = 200):
        self._spark, self._uri, self._flush_every = spark, uri, flush_every
        self._held: list[tuple] = []
        self._ended: set[str] = set()
        self._lock, self._writing = threading.Lock(), threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._held.append(_row(event.progress))
            full = len(self._held) >= self._flush_every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # Events of a query come in order, so all of its reports are here by now.
        self.flush()
        self._ended.add(str(event.runId))

    def flush(self) -> None:
        """Write what is held. Reports leave the list only once they are written; a failed write raises and keeps them."""
        with self._writing:
            with self._lock:
                rows = list(self._held)
            if not rows:
                return
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self._uri)
            with self._lock:
                del self._held[: len(rows)]

    def wait(self, queries: Iterable[StreamingQuery], seconds: float = 60) -> None:
        """Until the ends of the given (stopped) queries have been reported."""
        wanted, until = {str(query.runId) for query in queries}, time.monotonic() + seconds
        while not wanted <= self._ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no report of the end of {len(wanted - self._ended)} queries")
            time.sleep(0.05)

    def observed(self) -> DataFrame:
        """What the queries counted on their way (``DataFrame.observe``), added up: query, metric, total."""
        each = self.table().select("query", F.explode("observed").alias("metric", "value"))
        return each.groupBy("query", "metric").agg(F.sum("value").alias("total"))

    def table(self) -> DataFrame:
        """All reports so far, one row per micro-batch and run."""
        self.flush()
        return read_or_empty(self._spark, self._uri, T.StructType.fromDDL(PROGRESS))


def _row(report) -> tuple:
    states = report.stateOperators
    return (
        report.name,
        report.batchId,
        report.numInputRows,
        float(report.inputRowsPerSecond),
        float(report.processedRowsPerSecond),
        report.batchDuration,
        (report.eventTime or {}).get("watermark"),
        sum(s.numRowsTotal for s in states),
        sum(s.memoryUsedBytes for s in states),
        sum(s.numRowsDroppedByWatermark for s in states),
        {
            f"{name}.{key}": value
            for name, row in (report.observedMetrics or {}).items()
            for key, value in row.asDict().items()
            if isinstance(value, int)
        },
    )
