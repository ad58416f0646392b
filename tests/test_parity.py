"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracle import SQL
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    """Of the library itself; training-data operators have tests of their own."""
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    ours, theirs, differing, left, right = differences(spark, connection, name, SF)
    assert ours == theirs and not differing, (left, right)


def test_entry(spark):
    assert contract.entry(spark).count() == 515


def test_row_counts_by_stage(spark):
    queries = contract.queries()
    stages = ["bronze_scan", "handle_nulls", "deduplicate", "validate", "anomaly_summary"]
    assert [queries[s](spark, SF).count() for s in stages] == [1050, 1029, 980, 922, 49]
