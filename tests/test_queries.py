"""Every core query against its SQL on the smallest tables."""

import pytest

from loomspark import queries as core
from tests.oracle import connect, same


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, sf, con, name):
    same(core.queries()[name](spark, sf), con, core.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_query_runs(spark, sf, name):
    assert core.queries()[name](spark, sf).count() > 0


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["phase", "dataset", "exposures", "chars"]
    assert set(e.oracle_sql()) <= set(e.queries())
