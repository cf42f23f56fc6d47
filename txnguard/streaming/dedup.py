"""Replay de-duplication of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnguard.streaming.progress import passed_watermark, store_progress


def drop_repeats(
    stream: DataFrame,
    keys: Sequence[str],
    time_column: str,
    delay: str = "10 minutes",
    thin_first: bool = False,
) -> DataFrame:
    """One row per key, for repeats that arrive within ``delay`` of each other.

    All copies of a key meet in one state task, and everything stays in the
    JVM; ``start_once_per_key`` is for keys with very many copies. ``thin_first`` sends the rows through Python to remove repeats inside
    each Arrow batch before the shuffle, for streams in which one key makes up
    a large share and its copies arrive close together.
    """
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp"))
    if thin_first:
        timed = timed.mapInArrow(_first_per_key(list(keys)), timed.schema)
    return timed.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def _first_per_key(keys: list[str]):
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marked = pa.Table.from_batches([batch]).select(keys)
            marked = marked.append_column("_row", pa.array(range(batch.num_rows), pa.int64()))
            first = marked.group_by(keys, use_threads=False).aggregate([("_row", "min")])
            yield batch.take(first["_row_min"].combine_chunks().sort())

    return thin


def start_once_per_key(
    stream: DataFrame,
    keys: Sequence[str],
    time_column: str,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    every: str | None = None,
) -> StreamingQuery:
    """Store one row per key below ``path/kept``, whatever share of all rows one key has.

    Each trigger first reduces its rows to one per key by an aggregation, which
    combines inside the tasks before the shuffle: a key sends one row per task,
    not one per copy. Only those meet the keys stored by earlier triggers. The
    rule is that of ``drop_repeats``: a stored key counts until the watermark
    passes its time by ``delay``, and rows older than the watermark are dropped.

    Of the copies in a trigger the earliest stays, by time and then by the other
    columns. The stored rows are the state: they lie in partitions by the time
    at which they expire, so a trigger reads those that still count and of them
    the keys only. A trigger owns its partitions and replaces them, so one that
    is repeated after a failure changes nothing. Null keys are one key, and rows
    without a time are dropped.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed = passed_watermark(spark, f"{path}/progress", batch_id, delay)
        seen_time = Observation()
        timed = batch.withColumn(time_column, F.col(time_column).cast("timestamp"))
        timed = timed.observe(seen_time, F.max(time_column).alias("newest"))
        in_time = F.col(time_column).isNotNull() if passed is None else F.col(time_column) >= F.lit(passed)
        fresh = _first_of_batch(timed.filter(in_time), keys, time_column)
        fresh = _unseen(spark, fresh, keys, time_column, path, batch_id, passed, delay)
        expires = F.col(time_column) + F.expr(f"INTERVAL {delay}")
        slots = {"slot": _slot(expires, delay), "batch_id": F.lit(batch_id).cast("bigint")}
        writer = fresh.withColumns(slots).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slot", "batch_id").parquet(f"{path}/kept")
        store_progress(spark, f"{path}/progress", batch_id, seen_time.get["newest"])

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _slot(moment: Column, delay: str) -> Column:
    """The number of the hour of a moment, or of the stretch as long as ``delay`` if that is longer.

    Rows that count at one time lie in two or three slots, so a trigger writes few folders.
    """
    seconds = F.unix_timestamp(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {delay}"))
    return F.floor(F.unix_timestamp(moment) / F.greatest(seconds, F.lit(3600))).cast("bigint")


def _first_of_batch(rows: DataFrame, keys: Sequence[str], time_column: str) -> DataFrame:
    """The earliest row per key; the sort key holds the whole row, so the choice is the same in every run."""
    others = [c for c in rows.columns if c not in keys and c != time_column]
    first = rows.groupBy(*keys).agg(F.min(F.struct(time_column, *others)).alias("_first"))
    return first.select(*keys, "_first.*").select(*rows.columns)


def _unseen(
    spark: SparkSession, fresh: DataFrame, keys: Sequence[str], time_column: str, path: str, batch_id: int, passed, delay: str
) -> DataFrame:
    """Rows whose key no earlier trigger has stored, or stored so long ago that it has expired."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/kept")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return fresh
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema.fields]
    stored = spark.read.schema(", ".join([*kinds, "slot BIGINT", "batch_id BIGINT"])).parquet(f"{path}/kept")
    stored = stored.filter(F.col("batch_id") < batch_id)
    if passed is not None:
        alive = F.col(time_column) + F.expr(f"INTERVAL {delay}") > F.lit(passed)
        stored = stored.filter((F.col("slot") >= _slot(F.lit(passed), delay)) & alive)
    known = stored.select(*[F.col(key).alias(f"_seen_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_seen_{key}")) for key in keys]
    return fresh.join(known, same, "left_anti")


def kept_rows(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The stored rows of ``start_once_per_key``; ``columns`` is their schema."""
    return spark.read.schema(columns).parquet(f"{path}/kept")
