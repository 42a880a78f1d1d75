"""Every registered query against its SQL, on the smallest tables."""

import pytest

from registry import all_queries, all_sql
from tests.conftest import SF_SMALL
from tests.oracle import compare, connect

SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(all_queries()[name](spark, SF_SMALL), con, SQL[name]) is None


def test_every_query_is_checked():
    assert set(all_queries()) == set(SQL)
