"""Every registered query against its SQL on the smallest tables: columns, types, rows, values."""

import os

import duckdb
import pytest

from textmill.plans import registry

FOLDER = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, tables, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(columns).collect()]
    assert rows
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    listed = ", ".join(f'"{c}"' for c in columns)
    types = {r[0]: r[1] for r in tables.execute(f"DESCRIBE {sql}").fetchall()}
    assert types == {c: TYPES[t] for c, t in df.dtypes}
    want = tables.execute(f"SELECT {listed} FROM ({sql})").fetchall()
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(rows, key=key) == sorted(want, key=key)
