"""Every query equals its SQL on DuckDB."""

from __future__ import annotations

import pytest
from compare import SMALL, connect, difference

import __spark_entry__ as driver
from tradeloom.plans import oracle
from tradeloom.plans import queries as registry

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_llm_subpackage_may_be_missing():
    """Only a missing module is passed over, not an error inside one."""
    assert driver._module("tradeloom.no_such_package.queries") is None
    assert driver._module("no_such_pipeline") is None
    assert driver._module("tradeloom.plans.queries") is registry


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


def test_entry_is_not_empty(spark):
    assert driver.entry(spark).count() == 24
