"""Queries of operators against their SQL, over whole tables."""

import pytest

from clearwell.llm import queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLE_SQL[name]) == []
