"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest
from oracle import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

RUNS, SQLS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, RUNS[name], SQLS[name], sf_dir) == []


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQLS)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert RUNS[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["regiao", "net_sales"]
    assert df.count() == 5
