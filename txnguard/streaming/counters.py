"""Running counters and event-time windows over a scored stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnguard.operators.rules import counter_columns


def running_counters(scored: DataFrame) -> DataFrame:
    """The four KPI counters over everything seen; complete output mode.

    Partial aggregation leaves one row per task, and the state is one row.
    """
    return scored.agg(*[value.alias(name) for name, value in counter_columns().items()])


def running_fraud_counts(stream: DataFrame) -> DataFrame:
    """Rows seen, fraud rows and fraud share; complete output mode."""
    counted = stream.agg(F.count("*").alias("sent_rows"), F.count_if(F.col("isFraud") == 1).alias("fraud_rows"))
    share = F.coalesce(F.try_divide(F.col("fraud_rows") * 100.0, F.col("sent_rows")), F.lit(0.0))
    return counted.withColumn("fraud_percent", F.round(share, 4))


def windowed(
    stream: DataFrame,
    time_column: str,
    keys: Sequence[str],
    measures: dict[str, Column],
    width: str = "1 hour",
    delay: str = "10 minutes",
) -> DataFrame:
    """Measures per tumbling window and key; rows older than the watermark are late.

    Append output mode emits a window once the watermark has passed its end.
    """
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return (
        timed.withWatermark(time_column, delay)
        .groupBy(F.window(time_column, width), *keys)
        .agg(*[value.alias(name) for name, value in measures.items()])
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            *measures,
        )
    )


def windowed_counters(scored: DataFrame, time_column: str = "event_time", width: str = "1 hour") -> DataFrame:
    """The KPI counters per window and transaction type."""
    return windowed(scored, time_column, ["type"], counter_columns(), width)


def start_snapshots(result: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep a complete-mode result as a table of its last two snapshots.

    Batches alternate between two partitions, so a batch that is written
    again, or fails half-way, leaves the snapshot before it alone.
    """

    def store(snapshot: DataFrame, batch_id: int) -> None:
        stamped = snapshot.withColumns(
            {"batch_id": F.lit(batch_id).cast("bigint"), "slot": F.lit(batch_id % 2)}
        )
        writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slot").parquet(path)

    writer = result.writeStream.outputMode("complete").foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the last stored batch."""
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("batch_id")).first()[0]
    return stored.filter(F.col("batch_id") == newest).drop("batch_id", "slot")


def counters_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The four KPI counters as the last batch of ``running_counters`` left them in its state.

    Read from the checkpoint by the state store's own data source: no table of
    snapshots is needed, and the stream may be running or stopped.
    """
    names = list(counter_columns())
    kind = ", ".join(f"{name}: bigint" for name in names)
    # The buffers of the aggregates have one name each for count; they are told apart by their place.
    state = spark.read.format("statestore").load(checkpoint)
    buffers = state.select(F.col("value").cast(f"struct<{kind}>").alias("buffers"))
    return buffers.select([F.col("buffers")[name].alias(name) for name in names])
