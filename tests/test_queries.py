"""Every registered query against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import ORACLE, QUERIES, entry, queries

TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def canonical(rows):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(v + 0.0) if isinstance(v, float) else repr(v)

    return sorted(tuple(value(v) for v in row) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = duck.execute(f"SELECT {', '.join(f'{chr(34)}{c}{chr(34)}' for c in columns)} FROM ({ORACLE[name]})")
    expected = found.fetchall()
    types = {d[0]: d[1] for d in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    rows = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert rows and canonical(rows) == canonical(expected)


def test_entry(spark):
    report = entry(spark)
    assert report.columns[0] == "Mes" and report.count() == 82
