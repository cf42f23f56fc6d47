"""One stored row per trigger of every streaming query, also for empty and failed ones."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from txnguard.sources.shared_files import shared_files

_SCHEMA = (
    "query_id STRING, run_id STRING, name STRING, kind STRING, batch_id BIGINT, at STRING, input_rows BIGINT, "
    "input_rows_per_second DOUBLE, processed_rows_per_second DOUBLE, trigger_ms BIGINT, state_rows BIGINT, "
    "state_bytes BIGINT, late_rows BIGINT, problem STRING"
)


class TriggerReports(StreamingQueryListener):
    """Writes what the engine reports of each trigger to a folder of JSON rows.

    ``kind`` is ``batch`` (with or without rows), ``idle`` (the query found
    nothing to do), ``ended`` or ``failed``. A batch that is run again after a
    failure replaces its row. Rates, state size and rows dropped as late come
    from the engine's own measurements; nothing is counted a second time.
    """

    def __init__(self, path: str):
        self._path = path

    def _store(self, query_id: str, name: str, row: dict) -> None:
        files, root = shared_files(self._path)
        folder = f"{root}/query_id={query_id}"
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{name}.json") as out:
            out.write((json.dumps(row) + "\n").encode())

    def onQueryStarted(self, event) -> None:
        """Nothing has been done yet."""

    def onQueryProgress(self, event) -> None:
        found = event.progress
        states = found.stateOperators
        row = {
            "run_id": str(found.runId),
            "name": found.name,
            "kind": "batch",
            "batch_id": found.batchId,
            "at": found.timestamp,
            "input_rows": found.numInputRows,
            "input_rows_per_second": _number(found.inputRowsPerSecond),
            "processed_rows_per_second": _number(found.processedRowsPerSecond),
            "trigger_ms": found.durationMs.get("triggerExecution"),
            "state_rows": sum(s.numRowsTotal for s in states),
            "state_bytes": sum(s.memoryUsedBytes for s in states),
            "late_rows": sum(s.numRowsDroppedByWatermark for s in states),
        }
        self._store(str(found.id), f"batch-{found.batchId:012d}", row)

    def onQueryIdle(self, event) -> None:
        row = {"run_id": str(event.runId), "kind": "idle", "at": event.timestamp}
        self._store(str(event.id), f"idle-{event.timestamp.replace(':', '-')}", row)

    def onQueryTerminated(self, event) -> None:
        kind = "failed" if event.exception else "ended"
        row = {"run_id": str(event.runId), "kind": kind, "problem": event.exception}
        self._store(str(event.id), f"{kind}-{event.runId}", row)


def _number(value: float | None) -> float | None:
    """A finite rate; the engine reports NaN for a trigger without an interval."""
    return value if value is not None and value == value and abs(value) != float("inf") else None


def report_triggers(spark: SparkSession, path: str) -> TriggerReports:
    """Report all streams of a session to ``path`` until the listener is removed from ``spark.streams``."""
    listener = TriggerReports(path)
    spark.streams.addListener(listener)
    return listener


def wait_for_reports(spark: SparkSession) -> None:
    """Let the events of everything that has ended reach the listeners."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()


def stored_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(path)
