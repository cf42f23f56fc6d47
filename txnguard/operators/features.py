"""Derived balance and amount features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import flag
from txnguard.operators.clean import clean_transactions
from txnguard.schema import ALERT_COLUMNS, GOLD_COLUMNS, LARGE_AMOUNT, RULE_FLAGS


def add_features(df: DataFrame) -> DataFrame:
    """Five features of one transaction; a zero denominator gives a null ratio."""
    before, after = F.col("oldbalanceOrg"), F.col("newbalanceOrig")
    return df.withColumns(
        {
            "balance_diff_orig": before - after,
            "balance_diff_dest": F.col("newbalanceDest") - F.col("oldbalanceDest"),
            "amount_ratio": F.try_divide(F.col("amount"), before + F.lit(1.0)),
            "is_zero_balance_orig": flag(after == 0.0),
            "is_large_amount": flag(F.col("amount") > LARGE_AMOUNT),
        }
    )


def add_label(df: DataFrame) -> DataFrame:
    """The training label beside ``isFraud``."""
    return df.withColumn("label", F.col("isFraud").cast("double"))


def prepare_features(df: DataFrame) -> DataFrame:
    """Raw rows to model-ready rows; ``isFraud`` becomes ``label``."""
    return df.transform(clean_transactions).transform(add_features).withColumnRenamed("isFraud", "label")


def stamp_partitions(df: DataFrame, time_column: str = "processed_at") -> DataFrame:
    """``dt`` and ``hour`` of a time the rows already carry."""
    return df.withColumns(
        {
            "dt": F.date_format(time_column, "yyyy-MM-dd"),
            "hour": F.date_format(time_column, "HH"),
        }
    )


def gold_projection(df: DataFrame, *extra: str) -> DataFrame:
    """The scored-table columns, in order, plus any key columns asked for."""
    return df.select(*GOLD_COLUMNS, *extra)


def alert_rows(df: DataFrame, *extra: str) -> DataFrame:
    """Alerts only, in the published form: rounded scores and integer flags."""
    rounded = {c: F.round(c, 4) for c in ("fraud_probability", "rule_score", "hybrid_score")}
    whole = {c: F.col(c).cast("int") for c in RULE_FLAGS}
    shaped = {**rounded, **whole}
    return df.filter(F.col("is_alert") == 1.0).select(
        *[shaped.get(c, F.col(c)).alias(c) for c in ALERT_COLUMNS], *extra
    )


def alert_json(df: DataFrame, *extra: str) -> DataFrame:
    """One JSON text per alert in ``value``; null fields are written as null."""
    body = F.to_json(F.struct(*ALERT_COLUMNS), {"ignoreNullFields": "false"})
    keys = [name for name in extra if name not in ALERT_COLUMNS]
    return alert_rows(df, *keys).select(body.alias("value"), *extra)
