"""Queries that SQL can express, against DuckDB."""

import compare
import pytest

from gaugemill.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    df = queries.QUERIES[name](spark, sf_dir)
    assert compare.differences(df, compare.connect(sf_dir), oracle.oracle_sql()[name]) == []


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
