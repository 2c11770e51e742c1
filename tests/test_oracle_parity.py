"""Every registered job against its DuckDB oracle on sf0.001."""
import pytest

import __spark_entry__ as E
from daymatrix.plans.catalog import REGISTRY
from daymatrix.plans.verify import compare, duck

from conftest import SF_SMALL

QUERIES = {name: fn for name, fn in E.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in E.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_job_has_an_oracle():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_job_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "timestamp" in df.columns and df.count() > 0
