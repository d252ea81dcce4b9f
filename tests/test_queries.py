"""Registered queries against their SQL twins, on the smallest tables."""

import os

import pytest
from oracle import compare, connect

SF = os.environ.get("KGSPARK_TEST_SF", "/root/testdata/sf0.001")

if not os.path.isdir(SF):
    pytest.skip("driver tables are not here", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, con):
    _, _, diff = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert diff is None, diff


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
