"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as entry_points
from chartloom.plans.oracle import ORACLE
from chartloom.plans.registry import QUERIES
from compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
