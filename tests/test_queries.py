"""Every registered query against its DuckDB oracle on the smallest tables, and the
entry smoke check. (The training-data queries have their own tests.)"""

import pytest

import __spark_entry__ as entry
from jobmart.plans.oracle import SQL
from jobmart.plans.registry import QUERIES
from tests.conftest import SMOKE_DIR
from tests.oracle_check import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SMOKE_DIR)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "salary_avg" in df.columns


def test_oracle_covers_queries():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], SQL[name], SMOKE_DIR)
    assert res["status"] == "ok", res
