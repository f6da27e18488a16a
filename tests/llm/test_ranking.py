import random

import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import ranking

SCHEMA = "query_id bigint, strategy string, content_unit_id string, score double, distance double, query int, unit int"


def hits(spark, n_queries=4, units=15, seed=1):
    rng = random.Random(seed)
    rows = []
    for q in range(n_queries):
        for s, spread in (("a", 1.0), ("b", 1000.0), ("c", 0.01)):
            for u in rng.sample(range(units), units - 4):
                quality = -u + rng.gauss(0, 2)
                value = round(quality * spread, 1 if s == "b" else 4)
                rows.append((q, s, f"u{u}", None if s == "c" else value, -value if s == "c" else None, 0, 0))
    rows += [(0, "b", "u3", 1e300, None, 0, 0), (0, "b", "u3", None, None, 0, 0), (0, "a", "u2", float("nan"), None, 0, 0), (None, "a", "u1", 1.0, None, 0, 0), (1, None, "u1", 1.0, None, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(df):
    data = {}
    for r in df.collect():
        v = r["score"] if r["score"] is not None and r["score"] == r["score"] else None if r["distance"] is None else -r["distance"]
        if v is None or r["query_id"] is None or r["strategy"] is None:
            continue
        key = (r["query_id"], r["strategy"], r["content_unit_id"])
        data[key] = max(v, data.get(key, v))
    sources = sorted({k[1] for k in data})
    rows, keys = [], []
    for q in sorted({k[0] for k in data}):
        units = sorted({k[2] for k in data if k[0] == q})
        columns = []
        for s in sources:
            v = np.array([data.get((q, s, u), -np.inf) for u in units])
            columns.append((np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v]) - 0.5) / len(units))
        rows.append(np.array(columns).T)
        keys += [(q, u) for u in units]
    m = np.concatenate(rows)
    z = (m - m.mean(axis=0)) / m.std(axis=0)
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    return dict(zip(keys, z @ np.abs(vectors[:, -1]), strict=True))


def ranked(df, **kw):
    return ranking.fused_ranking(df, "query_id", "strategy", "content_unit_id", ranking.directed_value(F.col("score"), F.col("distance")), **kw)


def test_against_brute_force(spark):
    df = hits(spark)
    got = {(r["query_id"], r["content_unit_id"]): r["projection"] for r in ranked(df).collect()}
    want = brute(df)
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_hot_queries_give_the_same_ranks(spark):
    df = hits(spark, 3, 40)
    a = {(r[0], r[1]): (round(r[2], 9), r[3]) for r in ranked(df).collect()}
    b = {(r[0], r[1]): (round(r[2], 9), r[3]) for r in ranked(df, hot_rows=5).collect()}
    assert a == b


def test_no_score_prevails(spark):
    rows = [(1, "big", f"u{i}", float(i) * 1e9, None, 0, 0) for i in range(9)] + [(1, s, f"u{i}", float(-i), None, 0, 0) for s in ("s1", "s2") for i in range(9)]
    assert ranked(spark.createDataFrame(rows, SCHEMA), top=1).head()["content_unit_id"] == "u0"


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ranked(empty).count() == 0
    one = spark.createDataFrame([(1, "a", "x", 1.0, None, 0, 0), (1, "a", "y", 1.0, None, 0, 0)], SCHEMA)
    assert [r["content_unit_id"] for r in ranked(one).orderBy("position").collect()] == ["x", "y"]
