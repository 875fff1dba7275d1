"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from framewright.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{SF_DIR}/{name}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = database.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want, key=key)
    assert want
