"""Every query against its SQL twin in DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_each_query_has_its_twin():
    assert contract.queries().keys() - contract.MORE_QUERIES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql().keys() - contract.MORE_SQL.keys()))
def test_query(spark, duck, name):
    assert compare(contract.queries()[name](spark, FOLDER), duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0
