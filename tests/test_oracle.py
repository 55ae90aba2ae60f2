"""Every SQL-oracled query equals its DuckDB twin (sf0.001, fast)."""

import pytest

from attrition.plans.catalog import QUERIES
from attrition.plans.oracle_sql import ORACLE_SQL
from conftest import SF0001
from oracle_compare import compare, duck

KEYS = sorted(k for k in ORACLE_SQL if k in QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF0001), con, ORACLE_SQL[name])
    assert ok, msg


def test_every_query_registered_in_entry():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 60
