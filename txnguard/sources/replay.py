"""A replay of stored transactions at a bounded rate, as a streaming source of its own.

The rows lie in Parquet files in the order they are sent in, with an index of
rows per file. An offset is a number of rows sent. Like a producer that runs on
its own, the replay has sent ``rowsPerSecond`` rows for every second since
``startedAt``, whether somebody reads or not: a stream that was stopped goes on
from its checkpoint and finds what was sent meanwhile.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from txnguard.sources.events import encode_events
from txnguard.sources.shared_files import shared_files

ROWS_PER_FILE = 1_000_000
ROWS_PER_PARTITION = 100_000


def write_replay_table(
    df: DataFrame, path: str, *extra: str, order_by: str = "txn_id", rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Write transactions as events in the order of ``order_by``, and the index; returns the rows.

    One range exchange and one parallel write: file names rise with the ranges,
    so their order is the order of sending. Files hold at most ``rows_per_file``
    rows, so their number follows the rows. The index has one row per file.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    writer = encode_events(ranged, *extra).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.parquet(f"{path}/rows")
    files = spark.read.parquet(f"{path}/rows").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
    files.coalesce(1).sortWithinPartitions("file").write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


@dataclass
class _Slice(InputPartition):
    """Rows of one file."""

    file: str
    first: int
    rows: int


class ReplaySource(DataSource):
    """``spark.readStream.format("replay")`` with ``path``, ``rowsPerSecond``, ``startedAt`` (epoch seconds)."""

    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return "value STRING"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ReplayReader(self.options)


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options):
        # Spark hands over options without regard to case.
        self._path = options["path"]
        self._rate = float(options["rowsPerSecond"])
        self._started = float(options["startedAt"])
        self._most = int(options.get("rowsPerPartition", ROWS_PER_PARTITION))
        if self._rate <= 0 or self._most <= 0:
            raise ValueError("rowsPerSecond and rowsPerPartition must be positive")
        files, root = shared_files(self._path)
        index = pq.read_table(f"{root}/index", filesystem=files).sort_by("file")
        self._files = list(zip(index["file"].to_pylist(), index["rows"].to_pylist()))
        self._total = sum(rows for _, rows in self._files)

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        sent = int(max(0.0, time.time() - self._started) * self._rate)
        return {"row": min(self._total, sent)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """The rows between two offsets, cut at files and into parts of bounded size."""
        slices, before = [], 0
        for file, rows in self._files:
            first, last = max(start["row"], before), min(end["row"], before + rows)
            for at in range(first, last, self._most):
                slices.append(_Slice(file, at - before, min(self._most, last - at)))
            before += rows
        return slices

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        """The rows of a slice; row groups outside it are not read."""
        files, root = shared_files(self._path)
        with files.open_input_file(f"{root}/rows/{partition.file}") as opened:
            stored = pq.ParquetFile(opened)
            skip, left = partition.first, partition.rows
            for group in range(stored.num_row_groups):
                rows = stored.metadata.row_group(group).num_rows
                if skip >= rows:
                    skip -= rows
                    continue
                for batch in stored.iter_batches(10_000, row_groups=[group], columns=["value"]):
                    part = batch.slice(skip, left) if skip < batch.num_rows else batch.slice(0, 0)
                    skip = max(0, skip - batch.num_rows)
                    left -= part.num_rows
                    if part.num_rows:
                        yield part
                    if not left:
                        return

    def commit(self, end: dict) -> None:
        """Nothing to free: the rows stay for the next replay."""


def read_replay(spark: SparkSession, path: str, rows_per_second: float, started_at: float, **options: str) -> DataFrame:
    """The replay as a stream with a ``value`` column. Keep ``started_at`` over restarts of one stream."""
    spark.dataSource.register(ReplaySource)
    reader = spark.readStream.format("replay").options(**options)
    return reader.option("path", path).option("rowsPerSecond", rows_per_second).option("startedAt", started_at).load()


def stop_after(query: StreamingQuery, rows: int, drain: bool = False, seconds: float = 600.0) -> int:
    """Stop a stream over one replay once it has processed ``rows`` rows; returns how many it has.

    ``drain`` first lets it do what follows its last rows, such as emitting
    windows; only for a replay that has sent everything by then.
    """
    deadline, done = time.monotonic() + seconds, 0
    while done < rows and time.monotonic() < deadline:
        if not query.isActive:
            query.awaitTermination()  # raises what ended it
            break
        progress = query.lastProgress
        end = progress.sources[0].endOffset if progress and progress.sources else None
        # The offset's one number; how its text is quoted differs between releases.
        done = int(re.search(r"\d+", str(end))[0]) if end else 0
        time.sleep(0.05)
    if drain:
        query.processAllAvailable()
    query.stop()
    return done
