"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from sparkmart.plans.registry import all_queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    q = QUERIES[key]
    if q.sql:
        diff = compare(spark, con, q, FOLDER)
        assert diff is None or diff.startswith("EMPTY"), diff
    else:
        assert q(spark, FOLDER).count() > 0
