import datetime as dt
import random

from folioflow.operators import snapshots as sn
from tests.test_incremental import CATALOG, H, file


def changes(spark, rows):
    out = sn.catalog_changes(spark.createDataFrame(rows, CATALOG))
    return sorted((r["snapshot_id"], r["file_path"], r["change"]) for r in out.collect())


def test_changes(spark):
    rows = [
        file("/same", H["a"], 1), file("/same", "sha256:" + H["a"].upper(), 4, size=9, mtime=9.0),
        file("/new", H["a"], 4), file("/gone", H["a"], 1), file("/digest", H["a"], 1), file("/digest", H["b"], 4),
        file("/lost", H["a"], 1), file("/lost", None, 4), file("/lost2", None, 1, mtime=2.0), file("/lost2", "", 4),
        file("/both", None, 1), file("/both", None, 4), file(None, H["a"], 4),
        file("/twice", H["b"], 4, hour=2), file("/twice", H["a"], 4, hour=1), file("/twice", H["b"], 1), file("/twice", H["b"], 1),
    ]
    assert changes(spark, rows) == [(4, "/digest", "changed"), (4, "/gone", "removed"), (4, "/lost2", "changed"), (4, "/new", "added")]


def test_changed_fields_and_edges(spark):
    assert changes(spark, []) == []
    assert changes(spark, [file("/a", H["a"], 3)]) == []
    rows = spark.createDataFrame([(1, "x", 1, None, 7), (2, "x", 2, "s", 7)], "s int, k string, a int, b string, sign int")
    got = sn.snapshot_changes(rows, "s", "k", ["a", "b"]).collect()
    assert [(r["change"], r["changed_fields"]) for r in got] == [("changed", ["a", "b"])]


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [file(f"/{rng.randrange(30)}", rng.choice([H["a"], H["b"], None]), rng.choice([1, 2, 5]), rng.random(), size=rng.randrange(2), mtime=float(rng.randrange(2))) for _ in range(300)]
    last = {}
    for r in rows:
        key, rank = (r[0], r[11]), (r[1], r[10] or "", r[8], r[9])
        if key not in last or rank > last[key][0]:
            last[key] = (rank, r)
    want = []
    for prev, now in ((1, 2), (2, 5)):
        for path in {p for s, p in last if s in (prev, now)}:
            a, b = (last.get((s, path), (0, None))[1] for s in (prev, now))
            if a is None or b is None:
                want.append((now, path, "added" if a is None else "removed"))
            elif (a[10] != b[10]) if a[10] and b[10] else (a[8:10] != b[8:10]):
                want.append((now, path, "changed"))
    assert changes(spark, rows) == sorted(want)
    assert dt
