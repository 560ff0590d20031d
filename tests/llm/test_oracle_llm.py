"""Every query of the subpackage that SQL can express, against that SQL on whole tables."""

import pytest

from compare import connect, differences
from obsflow.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) == []
