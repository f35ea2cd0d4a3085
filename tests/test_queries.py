"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        assert rows
        return
    result = duck.execute(SQL[name])
    found = {d[0]: (i, TYPES[str(d[1])]) for i, d in enumerate(result.description)}
    assert columns == sorted(found)
    assert {c: t for c, t in df.dtypes} == {c: t for c, (_, t) in found.items()}
    want = sorted(tuple(plain(r[found[c][0]]) for c in columns) for r in result.fetchall())
    assert rows == want


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_flagship_entry(spark):
    assert entry.entry(spark).count() > 0
