"""The queries over whole query sets against their SQL, on tables with several groups of query vectors and hits that have pages."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_oracle import shown

DATA = "/root/testdata/sf0.1"
LEAST = {
    "vec_distance": ("query", 20), "section_spread": ("query", 20), "vec_topk_multi": ("questions", 4), "neighbors": ("trigger", 100),
    "expand_hits": ("trigger", 100), "dedup_prefer_original": ("content_unit_id", 100), "expand_search_hits": ("query_id", 2), "dedup_search_hits": ("query_id", 2),
    "bm25": ("query_id", 200),
}


@pytest.mark.parametrize("name", LEAST)
def test_query(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = entry.queries()[name](spark, DATA)
    rows = df.collect()
    column, least = LEAST[name]
    assert len({r[column] for r in rows}) >= least
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    order = sorted(df.columns)
    assert sorted(columns) == order
    assert sorted("|".join(shown(r[c]) for c in order) for r in rows) == sorted("|".join(shown(r[columns.index(c)]) for c in order) for r in result.fetchall())


def test_every_item_is_asked(spark, data):
    rows = entry.queries()["bm25"](spark, data).select("query_id").distinct().count()
    assert rows == spark.read.parquet(f"{data}/eval_items.parquet").where("text rlike '[A-Za-z0-9]'").count()
