"""The queries of the problems that SQL can state, against it."""

import pytest

from loomspark.llm import queries as llm
from tests.oracle import connect, same


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, sf, con, name):
    same(llm.queries()[name](spark, sf), con, llm.oracle_sql()[name])
