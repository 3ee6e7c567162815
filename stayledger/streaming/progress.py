"""Engine progress of running streams, written to a run table."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "kind string, query_id string, run_id string, name string, batch_id long, at string, "
    "input_rows long, rows_per_second double, batch_ms long, state_rows long, state_bytes long, "
    "late_rows long, watermark string, watermark_lag_ms long, error string"
)


def progress_row(progress: dict) -> dict:
    """One report of a stream as a row of PROGRESS, from the engine's JSON form."""
    states = progress.get("stateOperators") or []
    times = progress.get("eventTime") or {}
    return {
        "kind": "progress",
        "query_id": progress.get("id"),
        "run_id": progress.get("runId"),
        "name": progress.get("name"),
        "batch_id": progress.get("batchId"),
        "at": progress.get("timestamp"),
        "input_rows": sum(s.get("numInputRows") or 0 for s in progress.get("sources") or []),
        "rows_per_second": progress.get("processedRowsPerSecond"),
        "batch_ms": (progress.get("durationMs") or {}).get("triggerExecution"),
        "state_rows": sum(s.get("numRowsTotal") or 0 for s in states),
        "state_bytes": sum(s.get("memoryUsedBytes") or 0 for s in states),
        "late_rows": sum(s.get("numRowsDroppedByWatermark") or 0 for s in states),
        "watermark": times.get("watermark"),
        "event_time_max": times.get("max"),
    }


class ProgressWriter(StreamingQueryListener):
    """Appends a JSON line per report, start and end of every stream of the session to `path`.

    One small file a report: give the folder an expiry rule, or compact it now and then.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, **row) -> None:
        line = self.spark.createDataFrame([(json.dumps(row),)], "value string")
        line.coalesce(1).write.mode("append").text(self.path)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._append(
            kind="started", query_id=str(event.id), run_id=str(event.runId), name=event.name, at=event.timestamp
        )

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._append(**progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._append(
            kind="ended", query_id=str(event.id), run_id=str(event.runId), error=event.exception
        )


@contextmanager
def progress_to(spark: SparkSession, path: str) -> Iterator[None]:
    """Reports of all streams that run inside the block go to `path`; the block ends after the
    last of them is written."""
    writer = ProgressWriter(spark, path)
    spark.streams.addListener(writer)
    try:
        yield
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        spark.streams.removeListener(writer)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The run table; the lag is the newest event time of a batch less its watermark."""
    raw = spark.read.schema(f"{PROGRESS}, event_time_max string").json(path)
    millis = {c: F.unix_millis(F.try_to_timestamp(F.col(c))) for c in ("event_time_max", "watermark")}
    lag = millis["event_time_max"] - millis["watermark"]
    return raw.withColumn("watermark_lag_ms", lag).drop("event_time_max")
