"""Every registered query that has a SQL text must agree with it on the derived tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(rows):
    def key(row):
        return tuple((v is not None, str(type(v)), str(v)) for v in row)

    return sorted((tuple(normal(v) for v in row) for row in rows), key=key)


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    frame = spark_entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = comparable(tuple(r) for r in frame.select(*columns).collect())
    relation = duck.sql(spark_entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = comparable(duck.sql(f"SELECT {quoted} FROM ({spark_entry.oracle_sql()[name]})").fetchall())
    assert len(got) == len(want)
    assert got == want
    kinds = {"long": "BIGINT", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: kinds.get(t, t) for c, t in frame.dtypes} == types


@pytest.mark.parametrize("name", sorted(set(spark_entry.queries()) - set(spark_entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert spark_entry.queries()[name](spark, sf_dir).count() > 0
