"""Every query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import database, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.catalog.queries()
SQL = contract.oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, SQL[name]) == []


def test_golden_counts(spark):
    routes = contract.entry(spark).groupBy("route").count().collect()
    assert {r["route"]: r["count"] for r in routes} == {"success": 555, "failed": 294}


def test_rows_come_sorted(spark):
    rows = QUERIES["sort_by_partition"](spark, SF_DIR).select("year", "week_number").collect()
    assert rows == sorted(rows)
