"""A streaming sink for alerts with commit and abort per batch.

Tasks write their files aside. Commit gathers them in a folder that is not read
and renames it to ``run_id=…/batch_id=…`` in one step, so a reader sees a whole
batch or none. A batch that is repeated after a failure finds its folder there
and is discarded, so every alert is stored once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from txnguard.sources.shared_files import exists, shared_files


@dataclass
class _Staged(WriterCommitMessage):
    """What one task wrote aside, if it had rows."""

    file: str | None
    rows: int


class AlertSink(DataSource):
    """``writeStream.format("alert_feed")`` with ``path`` and ``runId``."""

    @classmethod
    def name(cls) -> str:
        return "alert_feed"

    def streamWriter(self, schema, overwrite) -> DataSourceStreamArrowWriter:
        return AlertWriter(self.options["path"], self.options["runId"])


class AlertWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, run_id: str):
        if not run_id or "/" in run_id:
            raise ValueError("runId must name one stream, without a slash")
        self._path, self._run = path, run_id

    def _place(self) -> tuple[fs.FileSystem, str]:
        files, root = shared_files(self._path)
        return files, f"{root}/run_id={self._run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = self._place()
        # Two attempts of a task never write the same file.
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                files.create_dir(f"{root}/_staged", recursive=True)
                writer = pq.ParquetWriter(f"{root}/_staged/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
        return _Staged(name if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        files, root = self._place()
        names = [m.file for m in messages if m is not None and m.file]
        target, moving = f"{root}/batch_id={batchId}", f"{root}/_moving-{batchId}"
        if not names:
            return
        if exists(files, target):
            self._discard(files, root, names)
            return
        if exists(files, moving):  # left by a commit that failed; its files are written anew
            files.delete_dir(moving)
        files.create_dir(moving)
        for name in names:
            files.move(f"{root}/_staged/{name}", f"{moving}/{name}")
        files.move(moving, target)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        files, root = self._place()
        self._discard(files, root, [m.file for m in messages if m is not None and m.file])

    @staticmethod
    def _discard(files: fs.FileSystem, root: str, names: list[str]) -> None:
        for name in names:
            if exists(files, f"{root}/_staged/{name}"):
                files.delete_file(f"{root}/_staged/{name}")


def start_alert_sink(
    feed: DataFrame, path: str, run_id: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send a feed (``alert_stream``) to the sink. One checkpoint has one ``run_id``, as with the layers."""
    feed.sparkSession.dataSource.register(AlertSink)
    writer = feed.writeStream.format("alert_feed").outputMode("append").option("runId", run_id)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def stored_alerts(spark: SparkSession, path: str, schema: str = "value STRING, txn_id BIGINT") -> DataFrame:
    """All committed alerts, with ``run_id`` and ``batch_id``; staged files are not seen."""
    return spark.read.schema(f"{schema}, run_id STRING, batch_id BIGINT").parquet(path)
