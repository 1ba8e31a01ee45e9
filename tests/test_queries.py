"""Every registered query of the core that has SQL agrees with it on the smallest tables; the others run."""

import pytest
from conftest import DATA

from spanloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(compare, name):
    compare(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
