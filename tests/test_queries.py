"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import inspect

import pytest

import __spark_entry__ as entry
from tests.check_sql import difference, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_registry():
    assert set(SQL) <= set(QUERIES)
    for run in QUERIES.values():
        assert list(inspect.signature(run).parameters) == ["spark", "sf_dir"]


def test_entry(spark):
    first = entry.entry(spark)
    assert first.count() > 0
    assert first.schema == entry.entry(spark).schema
