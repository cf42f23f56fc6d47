"""One local session for all tests, and row builders."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from txnguard.schema import TRANSACTION_SCHEMA, as_text_schema  # noqa: E402
from txnguard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "txnguard-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Own values, one row per situation.
_DEFAULTS = {
    "step": 3,
    "type": "PAYMENT",
    "amount": 120.5,
    "nameOrig": "C900",
    "oldbalanceOrg": 1000.0,
    "newbalanceOrig": 879.5,
    "nameDest": "M77",
    "oldbalanceDest": 10.0,
    "newbalanceDest": 130.5,
    "isFraud": 0,
    "isFlaggedFraud": 0,
}


@pytest.fixture(scope="session")
def rows(spark):
    """rows({...}, {...}) builds typed raw transactions from differences to a default."""

    def build(*changes: dict, text: bool = False):
        records = []
        for change in changes:
            record = {**_DEFAULTS, **change}
            values = [record[f.name] for f in TRANSACTION_SCHEMA.fields]
            records.append(tuple(None if v is None else str(v) for v in values) if text else tuple(values))
        return spark.createDataFrame(records, as_text_schema() if text else TRANSACTION_SCHEMA)

    return build
