"""Every registered query against its checking SQL, on whole tables."""

import pytest

import __spark_entry__ as driver
from compare import connect, differences

QUERIES = driver.QUERIES
SQL = driver.ORACLE_SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_entry_returns_facts(spark):
    facts = driver.entry(spark)
    assert facts.count() > 0
    assert len(facts.columns) == 17
