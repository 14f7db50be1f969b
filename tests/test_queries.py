"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, duck
from conftest import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_agrees_with_sql_without_cross_joins(spark, con, name):
    df = queries()[name](spark, SF)
    assert "NestedLoopJoin" not in plan(df) and "CartesianProduct" not in plan(df)
    assert differences(df, con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_returns_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert [r["month"] for r in entry(spark).collect()] == list(range(1, 13))
