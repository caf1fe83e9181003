"""Every registered query against its SQL on the smallest test tables."""

import oracle
import pytest
from conftest import DATA

import __spark_entry__ as contract

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    assert oracle.type_differences(df, duck, SQL[name]) == []
    assert oracle.compare(df, duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_sql_names_exist():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
