"""Every catalogue query with an SQL twin equals DuckDB's answer on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "nivel_criticidade" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
