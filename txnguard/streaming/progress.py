"""How far a stream written batch by batch has come: a watermark that is kept beside its tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_SCHEMA = "batch_id BIGINT, newest TIMESTAMP, slot INT"


def _stored(spark: SparkSession, path: str, batch_id: int):
    """The newest row before a batch, or None."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(_SCHEMA).parquet(path).filter(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()


def passed_watermark(spark: SparkSession, path: str, batch_id: int, delay: str) -> datetime | None:
    """The newest time of all earlier batches less ``delay``; None before any time was seen."""
    row = _stored(spark, path, batch_id)
    if row is None or row.newest is None:
        return None
    moment = spark.range(1).select((F.lit(row.newest) - F.expr(f"INTERVAL {delay}")).alias("passed"))
    return moment.first().passed


def store_progress(spark: SparkSession, path: str, batch_id: int, newest: datetime | None) -> None:
    """Note the newest time up to and with a batch.

    One row; batches alternate between two partitions, so a batch that is
    written again finds the row of the one before it.
    """
    row = _stored(spark, path, batch_id)
    times = [t for t in (newest, row.newest if row else None) if t is not None]
    known = spark.createDataFrame([(batch_id, max(times, default=None), batch_id % 2)], _SCHEMA)
    writer = known.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("slot").parquet(path)
