"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry_module
from weirflow.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(small_root="/root/testdata/sf0.001"):
    return duck(small_root)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, small, name):
    result = entry_module.queries()[name](spark, small)
    assert compare(result, con, entry_module.oracle_sql()[name]) is None
