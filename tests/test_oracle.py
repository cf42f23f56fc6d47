"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

from check_oracle import compare, connect
from given import TABLES
from txnguard.catalog.oracle import ORACLES
from txnguard.catalog.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(TABLES)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, connection, name):
    assert compare(QUERIES[name](spark, TABLES), connection, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
