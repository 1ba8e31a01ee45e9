"""The training-data queries that have SQL agree with it on the smallest tables; the others run."""

import pytest
from conftest import DATA

from spanloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees(compare, name):
    compare(QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() >= 0
