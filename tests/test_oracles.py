"""Every query with a SQL counterpart must agree with it on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SF)


def test_entry_has_rows(spark):
    result = entry(spark)
    assert "spam_rate" in result.columns and result.count() > 0


def test_each_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")
