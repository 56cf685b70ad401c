"""Every query of the folder: registered, whole, and equal to its SQL where it has one."""

import pytest

import __spark_entry__ as contract
from tests.compare import database, differences
from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(SF)


def test_all_queries_and_the_pipeline_are_registered():
    names = set(queries())
    assert {int(name[2:].split("_")[0]) for name in names} == set(range(1, 14))
    assert names | {"pipeline"} <= set(contract.queries())
    assert set(oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert differences(queries()[name](spark, SF), connection, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_covers_its_table(spark, name):
    if name.startswith("op12_"):
        return  # its SQL tells all its rows
    table = "pages" if name.startswith("op3_") else "documents"
    assert queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
