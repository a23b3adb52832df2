"""Streaming progress as metric rows."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from tidemark import schemas


class ProgressTable(StreamingQueryListener):
    """Stores every progress report as metric rows (metric, labels, ts, value).

    Reports are written ``every`` at a time, and what is left when a query ends or idles. As a context it listens from
    entry on, and its exit waits until the reports of all queries that ended inside are stored.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[tuple] = []
        self._reports = 0
        self._running: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressTable:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        with self._changed:
            self._changed.wait_for(lambda: not self._running, timeout=60)
        self._spark.streams.removeListener(self)

    def _store(self) -> None:
        if self._rows:
            self._spark.createDataFrame(self._rows, schemas.METRIC).coalesce(1).write.mode("append").parquet(self._path)
        self._rows, self._reports = [], 0

    def table(self) -> DataFrame:
        return self._spark.read.schema(schemas.METRIC).parquet(self._path)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self._rows += progress_rows(event.progress)
        self._reports += 1
        if self._reports >= self._every:
            self._store()

    def onQueryIdle(self, event) -> None:
        self._store()

    def onQueryTerminated(self, event) -> None:
        self._store()
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()


def progress_rows(progress) -> Iterator[tuple]:
    at = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    labels = {"query": progress.name or str(progress.id)}
    yield "batch_id", labels, at, float(progress.batchId)
    yield "input_rows", labels, at, float(progress.numInputRows)
    yield "batch_ms", labels, at, float(progress.batchDuration)
    for i, op in enumerate(progress.stateOperators):
        place = {**labels, "operator": str(i)}
        yield "state_rows", place, at, float(op.numRowsTotal)
        yield "late_rows_dropped", place, at, float(op.numRowsDroppedByWatermark)
    mark = (progress.eventTime or {}).get("watermark")
    if mark:
        seen = dt.datetime.fromisoformat(mark.replace("Z", "+00:00"))
        yield "watermark_ms", labels, at, seen.timestamp() * 1000
