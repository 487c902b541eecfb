"""Every query against its SQL form in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    widths = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert sorted(columns) == sorted(got.columns)
    assert {c: widths[t] for c, t in got.dtypes} == kinds
    expected, actual = _rows(columns, cursor.fetchall()), _rows(got.columns, got.collect())
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    assert differing[:2] == []
    assert actual, "a query must return rows"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
