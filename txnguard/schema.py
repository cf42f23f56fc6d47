"""Column names, types and scoring constants shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column names, value domain, thresholds, weights and label
# texts. They decide results and are part of the data contract.
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
DRAIN_TYPES = ("TRANSFER", "CASH_OUT")
INTEGER_COLUMNS = ("step", "isFlaggedFraud")
MONEY_COLUMNS = (
    "amount",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
)
ACCOUNT_COLUMNS = ("nameOrig", "nameDest")
ENGINEERED_COLUMNS = (
    "balance_diff_orig",
    "balance_diff_dest",
    "amount_ratio",
    "is_zero_balance_orig",
    "is_large_amount",
)
MODEL_INPUTS = MONEY_COLUMNS + ENGINEERED_COLUMNS + ("type_index",)
RULE_FLAGS = (
    "is_ml_alert",
    "is_blacklist_destination",
    "is_rule_blacklist",
    "is_rule_drain",
    "is_rule_large_txn",
    "is_rule_alert",
)
MAX_RECENT_ALERTS = 500
SPLIT_FRACTIONS = {"train": 0.70, "validation": 0.15, "test": 0.15}
DEFAULT_SEED = 42


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_INT, _TEXT, _REAL = T.IntegerType(), T.StringType(), T.DoubleType()

TRANSACTION_SCHEMA = _struct(
    ("step", _INT),
    ("type", _TEXT),
    ("amount", _REAL),
    ("nameOrig", _TEXT),
    ("oldbalanceOrg", _REAL),
    ("newbalanceOrig", _REAL),
    ("nameDest", _TEXT),
    ("oldbalanceDest", _REAL),
    ("newbalanceDest", _REAL),
    ("isFraud", _INT),
    ("isFlaggedFraud", _INT),
)
TRANSACTION_COLUMNS = tuple(TRANSACTION_SCHEMA.fieldNames())
# isFlaggedFraud has a safe default, so a missing value does not drop the row.
CRITICAL_COLUMNS = TRANSACTION_COLUMNS[:-1]

GOLD_COLUMNS = TRANSACTION_COLUMNS + (
    "prediction",
    "fraud_probability",
    "rule_score",
    "hybrid_score",
    *RULE_FLAGS,
    "is_alert",
    "alert_source",
    "processed_at",
    "dt",
    "hour",
)

ALERT_SCHEMA = _struct(
    ("step", _INT),
    ("type", _TEXT),
    ("amount", _REAL),
    ("nameOrig", _TEXT),
    ("nameDest", _TEXT),
    ("fraud_probability", _REAL),
    ("rule_score", _REAL),
    ("hybrid_score", _REAL),
    ("oldbalanceOrg", _REAL),
    ("newbalanceOrig", _REAL),
    *((flag, _INT) for flag in RULE_FLAGS),
    ("alert_source", _TEXT),
)
ALERT_COLUMNS = tuple(ALERT_SCHEMA.fieldNames())

EVALUATION_METRICS = ("accuracy", "precision", "recall", "f1", "auc")


@dataclass(frozen=True)
class ScoringConfig:
    """Thresholds and weights of the rule engine and the hybrid score."""

    blacklist_weight: float = 1.0
    drain_weight: float = 0.5
    large_weight: float = 0.5
    max_rule_score: float = 1.0
    probability_share: float = 0.7
    rule_share: float = 0.3
    alert_threshold: float = 0.75


LARGE_AMOUNT = 200000.0
DEFAULT_SCORING = ScoringConfig()


def as_text_schema(schema: T.StructType = TRANSACTION_SCHEMA) -> T.StructType:
    """The same fields, all strings: raw files are typed later with try_cast."""
    return _struct(*((field.name, _TEXT) for field in schema.fields))
