import json

import pytest

from txnguard.operators import features
from txnguard.operators.clean import clean_transactions
from txnguard.schema import ALERT_COLUMNS, ENGINEERED_COLUMNS, GOLD_COLUMNS


def test_formulas(rows):
    row = features.add_features(
        rows({"amount": 500.0, "oldbalanceOrg": 499.0, "newbalanceOrig": 0.0, "oldbalanceDest": 5.0, "newbalanceDest": 505.0})
    ).first()
    assert (row.balance_diff_orig, row.balance_diff_dest, row.amount_ratio) == (499.0, 500.0, 1.0)
    assert (row.is_zero_balance_orig, row.is_large_amount) == (1.0, 0.0)


def test_large_amount_is_strict(rows):
    found = features.add_features(rows({"amount": 200000.0}, {"amount": 200000.01})).collect()
    assert [r.is_large_amount for r in found] == [0.0, 1.0]


def test_zero_denominator_gives_null_ratio(rows):
    assert features.add_features(rows({"oldbalanceOrg": -1.0})).first().amount_ratio is None


def test_null_comparisons_are_zero(rows):
    row = features.add_features(rows({"newbalanceOrig": None, "amount": None})).first()
    assert (row.is_zero_balance_orig, row.is_large_amount) == (0.0, 0.0)


def test_exactly_five_columns_are_added(rows):
    raw = rows({})
    assert set(features.add_features(raw).columns) - set(raw.columns) == set(ENGINEERED_COLUMNS)


def test_prepare_renames_the_label(rows):
    prepared = features.prepare_features(rows({"isFraud": 1}, {"type": "bad"}))
    assert "isFraud" not in prepared.columns
    assert [r.label for r in prepared.collect()] == [1.0]
    assert dict(prepared.dtypes)["label"] == "double"


def test_label_beside_fraud_column(rows):
    row = features.add_label(clean_transactions(rows({"isFraud": 1}))).first()
    assert (row.isFraud, row.label) == (1.0, 1.0)


def test_column_lists():
    assert len(GOLD_COLUMNS) == 26
    assert len(ALERT_COLUMNS) == 17


@pytest.fixture
def alerting(rows):
    from pyspark.sql import functions as F

    from txnguard.operators.rules import score_rules

    ready = features.add_features(clean_transactions(rows({"type": "TRANSFER", "nameDest": "c5"}, {})))
    return score_rules(ready.withColumns({"prediction": F.lit(0.0), "fraud_probability": F.lit(0.123456)}), ["C5"])


def test_alert_rows_are_rounded_and_whole(alerting):
    (row,) = features.alert_rows(alerting).collect()
    assert row.asDict().keys() == set(ALERT_COLUMNS)
    assert row.fraud_probability == 0.1235
    assert row.is_rule_blacklist == 1 and isinstance(row.is_rule_blacklist, int)


def test_alert_json_holds_all_fields(alerting):
    (row,) = features.alert_json(alerting).collect()
    assert list(json.loads(row.value)) == list(ALERT_COLUMNS)
