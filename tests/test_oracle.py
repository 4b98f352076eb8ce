"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from checks.compare import mismatch, oracle_connection, oracle_rows, spark_rows
from checks.oracle import ORACLE
from checks.registry import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLE])
def test_matches_sql(spark, duck, key):
    expected = oracle_rows(duck, key)
    assert expected[1], "the SQL gives no rows"
    assert mismatch(expected, spark_rows(spark, SMALL, key)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_payments_that_do_not_reconcile_are_found(spark):
    assert QUERIES["dq_payment_reconciles"](spark, SMALL).first()["failures"] > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 2
    assert set(contract.queries()) >= set(QUERIES)
    assert contract.oracle_sql().items() >= ORACLE.items()
