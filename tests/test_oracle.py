"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
_REG = E.queries()
_SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(_REG))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, _REG[name], _SQL.get(name), SF)
    assert r["status"] in ("ok", "rows-only"), r
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
