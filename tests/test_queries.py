"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(
            f"create view {name.removesuffix('.parquet')} as select * from '{SF_DIR}/{name}'"
        )
    return connection


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_twin_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = QUERIES[name](spark, SF_DIR)
    rows = found.collect()
    if name not in ORACLES:
        assert rows
        return
    cursor = sql.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    assert by_name(rows, found.columns) == by_name(cursor.fetchall(), columns)


def test_entry(spark):
    assert contract.entry(spark).columns == ["doc_id", "summary"]
