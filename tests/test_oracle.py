"""Every registered query against its SQL on the smallest tables."""

import pytest
import compare
from conftest import plan_of

import __spark_entry__ as entry_point
from gaugemill.plans import oracle, registry

QUERIES = registry.QUERIES
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare.differences(df, con, ORACLES[name]) == []


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns[:2] == ["observe_date", "node_model_id"]
    assert result.count() > 0
