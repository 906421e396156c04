"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import load
from compare import connect, differences
from support import SF

QUERIES, CHECKS = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(queries()) and set(CHECKS) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, CHECKS[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
