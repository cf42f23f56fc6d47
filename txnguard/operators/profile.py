"""Data-quality and distribution profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.operators.blacklist import flag_listed
from txnguard.operators.clean import is_valid, standardize
from txnguard.operators.running import exact_quantiles
from txnguard.schema import ACCOUNT_COLUMNS, TRANSACTION_COLUMNS

AMOUNT_LEVELS = {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999}


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per transaction column, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in TRANSACTION_COLUMNS])


def blank_counts(df: DataFrame) -> DataFrame:
    """Null-or-blank values per text column, one pass."""
    return df.agg(
        *[
            F.count_if(F.trim(F.coalesce(F.col(c), F.lit(""))) == "").alias(c)
            for c in ("type", *ACCOUNT_COLUMNS)
        ]
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def fraud_rate(df: DataFrame, label: str = "isFraud") -> DataFrame:
    share = F.avg(F.col(label).cast("double")) * 100
    return df.agg(F.round(share, 6).alias("fraud_rate_percent"))


def counts_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("type").agg(F.count("*").alias("row_count")).orderBy("type")


def fraud_by_type(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("type")
        .agg(
            F.sum("isFraud").cast("bigint").alias("fraud_count"),
            F.round(F.avg("amount"), 4).alias("avg_amount"),
        )
        .orderBy("type")
    )


def amount_quantiles(df: DataFrame, levels: dict[str, float] | None = None) -> DataFrame:
    """Exact interpolated quantiles of ``amount``."""
    levels = levels or AMOUNT_LEVELS
    return exact_quantiles(df, "amount", levels).select(*[F.round(c, 4).alias(c) for c in levels])


def amount_quantiles_approx(
    df: DataFrame, levels: dict[str, float] | None = None, error: float = 0.01
) -> DataFrame:
    """Quantiles of ``amount`` within a relative rank error, one pass."""
    levels = levels or AMOUNT_LEVELS
    accuracy = max(1, round(1 / error))
    found = df.agg(F.percentile_approx("amount", list(levels.values()), accuracy).alias("q"))
    return found.select(*[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(levels)])


def blacklist_profile(df: DataFrame, blacklist) -> DataFrame:
    """Rows, fraud and mean amount of transfers into listed accounts and of the rest."""
    dest = df.withColumn("_dest", F.upper(F.trim("nameDest")))
    gated = (F.col("_hit") == 1.0) & (F.upper(F.trim("type")) == "TRANSFER")
    return (
        flag_listed(dest, blacklist, "_hit", "_dest")
        .groupBy(F.when(gated, 1).otherwise(0).alias("is_blacklist_transfer"))
        .agg(
            F.count("*").alias("row_count"),
            F.sum("isFraud").cast("bigint").alias("fraud_count"),
            F.round(F.avg("amount"), 4).alias("avg_amount"),
        )
        .orderBy("is_blacklist_transfer")
    )


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percentage per class; the total is summed over the class rows."""
    everything = Window.partitionBy()
    return (
        df.groupBy(label)
        .agg(F.count("*").alias("class_count"))
        .withColumn(
            "class_percent",
            F.round(F.col("class_count") * 100.0 / F.sum("class_count").over(everything), 4),
        )
    )


def summary_columns() -> list:
    """Raw, clean and dropped rows and the clean rows' fraud rate, of standardized rows."""
    valid = is_valid()
    return [
        F.count("*").alias("raw_rows"),
        F.count_if(valid).alias("clean_rows"),
        F.count_if(~valid).alias("dropped_rows"),
        F.round(F.avg(F.when(valid, F.col("isFraud"))) * 100, 6).alias("fraud_rate_percent"),
    ]


def dataset_summary(df: DataFrame) -> DataFrame:
    """The summary of a raw table, in one pass."""
    return standardize(df).agg(*summary_columns())


def type_ranks(df: DataFrame) -> DataFrame:
    """Index of each type as the string indexer assigns it: by count, then name."""
    order = Window.orderBy(F.desc("row_count"), F.asc("type"))
    return (
        df.groupBy("type")
        .agg(F.count("*").alias("row_count"))
        .withColumn("type_index", (F.row_number().over(order) - 1).cast("double"))
    )


def file_check(df: DataFrame, path: str, required: Sequence[str] = (), pattern: str = "*.parquet") -> DataFrame:
    """Files, rows and bytes of the table stored at ``path``, and the required columns it lacks.

    Files without a row count too: a second source lists the files themselves,
    without their content, and counts them in its tasks.
    """
    files = df.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count("*").alias("rows"))
    there = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", pattern)
    listed = there.option("recursiveFileLookup", True).load(path).agg(F.count("*").cast("bigint").alias("listed"))
    lacking = [name for name in required if name not in df.columns]
    counted = files.agg(
        F.count("*").alias("filled"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )
    # One row each.
    both = counted.unionByName(listed, allowMissingColumns=True)
    return both.agg(
        F.max("listed").alias("file_count"),
        (F.max("listed") - F.max("filled")).alias("empty_files"),
        F.max("row_count").alias("row_count"),
        F.max("total_bytes").alias("total_bytes"),
        F.lit(",".join(lacking)).alias("missing_columns"),
    )
