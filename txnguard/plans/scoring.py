"""Raw transactions to scored rows, for a batch or a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.columns import evaluate_once, positive_class
from txnguard.operators.clean import clean_transactions
from txnguard.operators.features import add_features, add_label
from txnguard.operators.rules import score_rules
from txnguard.schema import DEFAULT_SCORING, ScoringConfig


def model_scorer(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """A scorer that applies a fitted model, once per row and without Python."""

    def score(df: DataFrame) -> DataFrame:
        found = {"prediction": F.col("prediction"), "fraud_probability": positive_class("probability")}
        return evaluate_once(model.transform(df), found)

    return score


def score_transactions(
    raw: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    blacklist=None,
    config: ScoringConfig = DEFAULT_SCORING,
) -> DataFrame:
    """Clean, derive features, apply the model, then rules and hybrid score."""
    ready = raw.transform(clean_transactions).transform(add_label).transform(add_features)
    return score_rules(scorer(ready), blacklist, config)
