"""Queries with SQL, over the whole smallest tables, and the results each query must have."""

import pytest

import __spark_entry__ as entry
from inkprint.llm import queries
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
