"""Every query with SQL gives the same rows in DuckDB, at the smallest scale."""

import pytest

from concord.queries import REGISTRY
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, REGISTRY[name], SF) == ""
