"""Every query against its reference SQL."""

import duckdb
import pytest

import __spark_entry__ as driver
from workload import oracle
from workload import queries as workload_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_reference_sql():
    assert set(workload_queries.registered()) == set(oracle.registered())
    assert set(workload_queries.registered()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(workload_queries.registered()))
def test_query(spark, sf_dir, duck, name):
    rows = driver.queries()[name](spark, sf_dir)
    answer = duck.execute(driver.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(rows.columns) == sorted(names)
    found = [tuple(r) for r in rows.select(*names).collect()]
    expected = answer.fetchall()
    assert len(found) == len(expected) > 0
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_entry(spark):
    assert driver.entry(spark).count() > 0
