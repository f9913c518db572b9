"""Starting, watching and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

ALL_AVAILABLE = "all available"


def start(writer: DataStreamWriter, every: float | str | None = None) -> StreamingQuery:
    """Start a query: every so many seconds, as fast as possible (None), or over what is there and no more."""
    if every == ALL_AVAILABLE:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=f"{every} seconds")
    return writer.start()


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a bounded query; its failure is raised here."""
    query.awaitTermination()
    return query


def keep_alive(query: StreamingQuery, pause: int = 9, stop_when: Callable[[], bool] | None = None) -> None:
    """Hold a submitted job open while its query runs."""
    while not query.awaitTermination(pause):
        if stop_when is not None and stop_when():
            query.stop()


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session; returns how many there were."""
    active = spark.streams.active
    for query in active:
        query.stop()
    return len(active)


def watch(query: StreamingQuery) -> dict:
    """Where a query stands: active or not, its status, and the figures of the last trigger."""
    last = query.lastProgress
    return {
        "active": query.isActive,
        "message": query.status["message"],
        "batch": last and last.batchId,
        "input_rows": last and last.numInputRows,
        "rows_per_second": last and last.processedRowsPerSecond,
        "durations_ms": last and dict(last.durationMs),
        "late_rows": last and sum(op.numRowsDroppedByWatermark for op in last.stateOperators),
        "state_bytes": last and sum(op.memoryUsedBytes for op in last.stateOperators),
    }


class BatchLog(StreamingQueryListener):
    """Keeps (query name, batch, input rows) of every micro-batch of the session."""

    def __init__(self) -> None:
        self.batches: list[tuple[str | None, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches.append((event.progress.name, event.progress.batchId, event.progress.numInputRows))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
