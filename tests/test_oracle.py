"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry


def shown(v):
    if v is None:
        return "N"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 5) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:26].replace("+00:00", "")
    return str(v)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(df.columns)
    assert sorted(columns) == order
    want = sorted("|".join(shown(r[columns.index(c)]) for c in order) for r in result.fetchall())
    assert sorted("|".join(shown(r[c]) for c in order) for r in rows) == want


def test_entry_and_absent_subpackage(spark):
    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
