"""Read-side queries over the stored layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.functions.columns import evaluate_once
from txnguard.operators.rules import alert_counters
from txnguard.schema import ALERT_SCHEMA, MAX_RECENT_ALERTS
from txnguard.streaming import layers

COUNTERS = ("total_transactions", "total_fraud", "total_ml_alerts", "total_rule_alerts")


def _with_rate(counters: DataFrame) -> DataFrame:
    share = F.col("total_fraud") / F.col("total_transactions") * 100
    rate = F.when(F.col("total_transactions") > 0, F.round(share, 4)).otherwise(0.0)
    return counters.withColumn("fraud_rate", rate)


def kpis(gold: DataFrame) -> DataFrame:
    """KPI row computed from scored rows; ``total_fraud`` counts alerts."""
    return _with_rate(alert_counters(gold))


def kpis_from_batches(batch_metrics: DataFrame, *more: Column) -> DataFrame:
    """The same row summed from per-batch counters, without reading scored rows; ``more`` are further aggregates."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    return _with_rate(batch_metrics.agg(*sums, *more))


def in_days(table: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Restrict a layer to a ``dt`` range, which prunes its partitions."""
    if first:
        table = table.filter(F.col("dt") >= first)
    if last:
        table = table.filter(F.col("dt") <= last)
    return table


def recent_alerts(alerts: DataFrame, limit: int = 50, *order: str) -> DataFrame:
    """The newest alerts; ``order`` lists sort columns, newest first.

    Each task keeps its own top rows, so at most ``limit`` rows per task move.
    """
    if not 1 <= limit <= MAX_RECENT_ALERTS:
        raise ValueError(f"limit must be between 1 and {MAX_RECENT_ALERTS}, not {limit}")
    keys = order or ("processed_at", "batch_id", "step", "txn_id")
    return alerts.orderBy(*[F.desc(key) for key in keys]).limit(limit)


def newest_alerts(spark: SparkSession, config: layers.LayerConfig, limit: int = 50, *order: str) -> DataFrame:
    """The newest alerts of a stored feed, reading no more hours than hold them.

    Hours are the partitions of the feed and follow ``processed_at``, so the
    newest rows lie in the newest hours. These are taken one, two, four … at a
    time until enough rows are found; older folders are neither listed nor read.
    ``order`` ranks rows as in ``recent_alerts`` and must begin with the time.
    """
    if not 1 <= limit <= MAX_RECENT_ALERTS:
        raise ValueError(f"limit must be between 1 and {MAX_RECENT_ALERTS}, not {limit}")
    hours = layers.hours_of(spark, config, "alerts")
    taken, found, step = 0, 0, 1
    while found < limit and taken < len(hours):
        part = layers.read_hours(spark, config, "alerts", hours[taken : taken + step])
        found += part.limit(limit - found).count()
        taken, step = taken + step, 2 * step
    if not hours:
        return spark.createDataFrame([], "value STRING, txn_id STRING, step INT, processed_at TIMESTAMP, dt STRING, hour STRING")
    return recent_alerts(layers.read_hours(spark, config, "alerts", hours[:taken]), limit, *order)


def parse_alerts(feed: DataFrame, *keep: str) -> DataFrame:
    """Alert JSON in ``value`` to columns; text that is no JSON object is skipped.

    A field of another type is converted where it can be, as ``"12.5"`` to a
    number, and is null otherwise; the alert stays.
    """
    read = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    fields = evaluate_once(feed.filter("value IS NOT NULL"), {"_fields": read}).filter("_fields IS NOT NULL")

    def typed(field: T.StructField):
        text = F.col("_fields")[field.name]
        if isinstance(field.dataType, T.IntegralType):
            return text.try_cast("double").try_cast(field.dataType)
        return text.try_cast(field.dataType)

    return fields.select(*[typed(field).alias(field.name) for field in ALERT_SCHEMA.fields], *keep)


def model_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, float]:
    """Metrics of the deployed model by name; raises if none are stored."""
    found = {row.metric: row.value for row in spark.read.format(fmt).load(path).collect()}
    if not found:
        raise LookupError("no metrics available")
    return found
