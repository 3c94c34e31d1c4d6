"""Every registered query against the same result in SQL, at the smallest scale."""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points

SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert rows
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return
    relation = db.sql(sql)
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    at = [relation.columns.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=str)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["store", "item", "ds", "yhat", "yhat_lower", "yhat_upper"]
