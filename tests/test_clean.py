import math

import pytest

from txnguard.operators import clean
from txnguard.schema import TRANSACTION_SCHEMA


def test_missing_columns_are_named_in_order(rows):
    with pytest.raises(ValueError, match="amount, nameDest"):
        clean.require_columns(rows({}).drop("nameDest", "amount"))


def test_extra_columns_pass_through(rows):
    from pyspark.sql import functions as F

    kept = clean.clean_transactions(rows({}).withColumn("note", F.lit("x")))
    assert kept.first().note == "x"
    assert kept.columns == [*TRANSACTION_SCHEMA.fieldNames(), "note"]


def test_text_is_normalised_and_flag_defaults(rows):
    row = clean.clean_transactions(
        rows({"type": "  cash   out ", "nameOrig": " c1 ", "nameDest": "m2 ", "isFlaggedFraud": None})
    ).first()
    assert (row.type, row.nameOrig, row.nameDest, row.isFlaggedFraud) == ("CASH_OUT", "C1", "M2", 0)
    assert isinstance(row.isFraud, float)


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"step": None}, "missing_step"),
        ({"amount": math.nan}, "missing_amount"),
        ({"oldbalanceOrg": None}, "missing_oldbalanceOrg"),
        ({"newbalanceDest": None}, "missing_newbalanceDest"),
        ({"isFraud": None}, "missing_isFraud"),
        ({"type": None}, "blank_type"),
        ({"nameOrig": "   "}, "blank_nameOrig"),
        ({"nameDest": ""}, "blank_nameDest"),
        ({"type": "cash-out"}, "unknown_type"),
        ({"type": "\tCASH_OUT"}, "unknown_type"),  # only spaces are trimmed
        ({"type": "REFUND"}, "unknown_type"),
    ],
)
def test_each_fault_drops_the_row_for_its_reason(rows, change, reason):
    raw = rows(change, {})
    assert clean.clean_transactions(raw).count() == 1
    assert {(r.reason, r.row_count) for r in clean.drop_reasons(raw).collect()} == {(reason, 1), ("kept", 1)}


def test_null_flag_is_not_critical(rows):
    assert clean.clean_transactions(rows({"isFlaggedFraud": None})).count() == 1


def test_text_cells_are_cast_and_bad_ones_drop(rows):
    raw = rows({"step": "1.5"}, {"step": " 7 "}, {"amount": "12,5"}, {"isFraud": "yes"}, {"amount": "1e3"}, text=True)
    found = sorted((r.step, r.amount) for r in clean.clean_transactions(raw).collect())
    assert found == [(1, 120.5), (3, 1000.0), (7, 120.5)]


def test_counts_reconcile(rows):
    found = clean.cleaning_counts(rows({}, {"type": "x"}, {"amount": None})).first()
    assert (found.raw_rows, found.clean_rows, found.dropped_rows) == (3, 1, 2)


def test_cleaning_is_one_scan_without_shuffle(rows):
    plan = clean.clean_transactions(rows({}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
