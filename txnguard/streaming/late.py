"""Rows that come too late for their window: counted and kept instead of lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnguard.streaming.progress import passed_watermark, store_progress


def start_late_split(
    stream: DataFrame,
    time_column: str,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    every: str | None = None,
) -> StreamingQuery:
    """Store every row below ``path/rows``, parted into rows in time and late ones.

    A row is late if its time lies before the newest time of all earlier
    triggers less ``delay``. The engine's own aggregations drop by the watermark
    of one trigger before, so windows over the rows in time lose nothing, and
    the late ones stand beside them to be counted or added later. Rows without a time are late. A trigger owns its
    partitions and replaces them, so one that is repeated changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed = passed_watermark(spark, f"{path}/progress", batch_id, delay)
        newest = Observation()
        timed = batch.withColumn(time_column, F.col(time_column).cast("timestamp"))
        timed = timed.observe(newest, F.max(time_column).alias("newest"))
        missing = F.col(time_column).isNull()
        late = missing if passed is None else missing | (F.col(time_column) < F.lit(passed))
        stamped = timed.withColumns({"late": late.cast("int"), "batch_id": F.lit(batch_id).cast("bigint")})
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("late", "batch_id").parquet(f"{path}/rows")
        store_progress(spark, f"{path}/progress", batch_id, newest.get["newest"])

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def split_rows(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """All stored rows with ``late`` (0 or 1) and ``batch_id``; a filter on ``late`` reads that part only."""
    return spark.read.schema(f"{columns}, late INT, batch_id BIGINT").parquet(f"{path}/rows")
