"""Every registered query against its SQL."""

import compare
import pytest

import __spark_entry__ as entry_points
from parcelflow.plans.oracles import ORACLES as PLAN_SQL
from parcelflow.plans.queries import QUERIES as PLANS

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


def test_every_query_has_sql():
    assert set(PLANS) == set(PLAN_SQL) and set(PLANS) <= set(QUERIES) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, connection, name):
    assert compare.difference(QUERIES[name](spark, folder), connection, ORACLES[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
