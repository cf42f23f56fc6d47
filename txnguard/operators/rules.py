"""Business rules, the hybrid score and the alert label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import flag
from txnguard.operators.blacklist import flag_listed
from txnguard.schema import DEFAULT_SCORING, DRAIN_TYPES, ScoringConfig

# Label texts in the order they are joined.
_SOURCE_LABELS = {
    "is_ml_alert": "ML",
    "is_rule_blacklist": "BLACKLIST_RULE",
    "is_rule_drain": "DRAIN",
    "is_rule_large_txn": "LARGE_TXN",
}
_NO_ALERT, _MODEL_ONLY, _SCORE_ONLY = "NONE", "ML_MODEL", "HYBRID_SCORE"


def _on(name: str):
    return F.col(name) == 1.0


def add_rule_flags(df: DataFrame, blacklist=None) -> DataFrame:
    """Model flag and the three rules, each 0.0 or 1.0, and their union."""
    kind = F.upper(F.coalesce(F.col("type"), F.lit("")))
    return (
        flag_listed(df, blacklist, "is_rule_blacklist")
        .withColumns(
            {
                "is_ml_alert": flag(_on("prediction")),
                "is_blacklist_destination": F.col("is_rule_blacklist"),
                "is_rule_drain": flag(_on("is_zero_balance_orig") & kind.isin(*DRAIN_TYPES)),
                "is_rule_large_txn": flag(_on("is_large_amount")),
            }
        )
        .withColumn(
            "is_rule_alert",
            flag(F.greatest("is_rule_blacklist", "is_rule_drain", "is_rule_large_txn") == 1.0),
        )
    )


def add_hybrid_score(df: DataFrame, config: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    """Capped weighted rule score, blended with the model probability."""
    weighted = (
        F.col("is_rule_blacklist") * config.blacklist_weight
        + F.col("is_rule_drain") * config.drain_weight
        + F.col("is_rule_large_txn") * config.large_weight
    )
    blended = F.col("fraud_probability") * config.probability_share + F.col("rule_score") * config.rule_share
    urgent = (F.col("hybrid_score") >= config.alert_threshold) | _on("is_rule_blacklist")
    return (
        df.withColumn("rule_score", F.least(weighted, F.lit(config.max_rule_score)))
        .withColumn("hybrid_score", blended)
        .withColumn("is_alert", flag(urgent))
    )


def add_alert_source(df: DataFrame) -> DataFrame:
    """Why a row alerts: the raised flags joined by '+', or NONE.

    An alert with no flag at all is HYBRID_SCORE, one by the model alone is
    ML_MODEL. With probabilities up to 1 neither can occur.
    """
    raised = F.concat_ws("+", *[F.when(_on(name), text) for name, text in _SOURCE_LABELS.items()])
    return df.withColumn(
        "alert_source",
        F.when(F.col("is_alert") == 0.0, _NO_ALERT)
        .when(raised == "", _SCORE_ONLY)
        .when(raised == _SOURCE_LABELS["is_ml_alert"], _MODEL_ONLY)
        .otherwise(raised),
    )


def score_rules(df: DataFrame, blacklist=None, config: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    """Flags, scores and label for rows that carry a model score.

    ``blacklist`` may be names, a DataFrame with column ``account`` or an
    ``AccountList`` measured beforehand (a stream measures it once at start).
    """
    return (
        df.transform(add_rule_flags, blacklist)
        .transform(add_hybrid_score, config)
        .transform(add_alert_source)
    )


def counter_columns() -> dict:
    """The four KPI counters as aggregates over scored rows."""
    return {
        "total_transactions": F.count("*"),
        "total_fraud": F.count_if(_on("is_alert")),
        "total_ml_alerts": F.count_if(_on("is_ml_alert")),
        "total_rule_alerts": F.count_if(_on("is_rule_alert")),
    }


def alert_counters(df: DataFrame) -> DataFrame:
    """All four counters in one aggregate."""
    return df.agg(*[value.alias(name) for name, value in counter_columns().items()])


def alerts_by_source(df: DataFrame) -> DataFrame:
    """Alert count, amount and mean score per alert source and type."""
    return (
        df.filter(_on("is_alert"))
        .groupBy("alert_source", "type")
        .agg(
            F.count("*").alias("alert_count"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
            F.round(F.avg("hybrid_score"), 6).alias("avg_hybrid_score"),
        )
    )
