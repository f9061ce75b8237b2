"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["statistical_impact", "sequence_forecast"])
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "early_warning" in out.columns
