"""Every registered query against its SQL counterpart."""

import oracle
import pytest

import __spark_entry__ as entry_points
from engage.queries.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(data_dir):
    return oracle.connect(data_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data_dir, name):
    assert oracle.differences(QUERIES[name](spark, data_dir), con, ORACLE[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
