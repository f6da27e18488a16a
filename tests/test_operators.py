"""Cases of the search, content and answer operators that the oracle's tables do not hold."""

from pyspark.sql import functions as F

from folioflow.operators import answers, content, expand, findings, fusion, lexical, planning, store, vector

HITS = "query_id bigint, strategy string, sub_query int, content_unit_id string, score double, distance double"


def test_normalise(spark):
    rows = [(1, "content_vector", None, u, None, d) for u, d in (("a", 0.2), ("b", 0.5), ("c", 1.0))]
    rows += [(1, "bm25", None, u, 0.0, None) for u in "ab"] + [(1, "hyde_vector", None, "z", None, 0.3), (1, "keyword_array", None, "n", None, None), (None, "bm25", None, "a", 1.0, None)]
    got = {(r["strategy"], r["content_unit_id"]): round(r["normalised"], 6) for r in fusion.normalised_hits(spark.createDataFrame(rows, HITS)).collect()}
    assert got == {("content_vector", "a"): 0.8, ("content_vector", "b"): 0.5, ("content_vector", "c"): 0.0, ("bm25", "a"): 1.0, ("bm25", "b"): 1.0, ("hyde_vector", "z"): 0.0, ("keyword_array", "n"): 1.0}


def test_fusion_weights_and_bounds(spark):
    rows = [(1, "bm25", None, "a", 0.8, None), (1, "bm25", None, "b", 1.0, None), (1, "unknown", None, "c", 1.0, None)]
    got = {r["content_unit_id"]: r["score"] for r in fusion.fused(spark.createDataFrame(rows, HITS), {"bm25": 0.1}).collect()}
    assert round(got["a"], 6) == 0.08 and round(got["b"], 6) == 0.1 and got["c"] == 0.0
    assert fusion.fused(spark.createDataFrame([], HITS)).count() == 0


def test_floor_of_the_judge(spark):
    c = spark.createDataFrame([(1, f"u{i}", i) for i in range(1, 13)], "query_id int, content_unit_id string, position int")
    removed = spark.createDataFrame([(1, i) for i in (1, 2, 3, 4, 5, 6, 7, 8, 99)], "query_id int, position int")
    kept = sorted(r["position"] for r in fusion.kept_by_judge(c, removed, 10).collect())
    assert kept == [1, 2, 3, 4, 5, 6, 9, 10, 11, 12]
    assert sorted(r["position"] for r in fusion.kept_by_judge(c, removed, 13).collect()) == [9, 10, 11, 12]


def test_query_text(spark):
    df = spark.createDataFrame([(["CET1", "Tier 1", "cet1", "5%"], "x"), ([], "net-interest"), ([""], "%"), ([], "??")], "t array<string>, f string")
    assert [r[0] for r in df.select(lexical.query_text(F.col("t"), F.col("f"))).collect()] == ['CET1 OR "Tier 1" OR "5 percentage"', '"net interest"', "percentage", "??"]


def test_nearest_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.normal(size=(60, 5))
    m[7] = m[3]
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(60, None), (61, []), (62, [0.0] * 5), (63, [1.0, 2.0]), (None, m[0].tolist())]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = vector.nearest(df.withColumnRenamed("id", "unit"), df.where("id in (3, 20, 60, 62)").withColumnRenamed("id", "query"), 4).collect()
    n = m / np.linalg.norm(m, axis=1)[:, None]
    for q in (3, 20):
        d = 1 - n @ n[q]
        want = sorted(range(60), key=lambda i: (round(d[i], 9), i))[:4]
        assert [r["unit"] for r in sorted((r for r in got if r["query"] == q), key=lambda r: r["rank"])] == want
    assert {r["query"] for r in got} == {3, 20}


def test_greedy_batches_and_prefix(spark):
    items = spark.createDataFrame([("d", i, n) for i, n in enumerate([60, 50, 30, 200, 10, None])] + [("e", 0, 500)], "d string, i int, n int")
    got = sorted((r["d"], r["i"], r["batch"]) for r in content.greedy_batches(items, "d", ["i"], "n", 100).collect())
    assert got == [("d", 0, 1), ("d", 1, 2), ("d", 2, 2), ("d", 3, 3), ("d", 4, 4), ("d", 5, 4), ("e", 0, 1)]
    kept = content.budget_prefix(items, "d", [F.col("i")], "n", 115).collect()
    assert sorted((r["d"], r["i"]) for r in kept) == [("d", 0), ("d", 1), ("e", 0)]


def test_layouts(spark):
    rows = [("pdf", "intro text", 5), ("pdf", "| a |\n| b |\n| c |\n|d|", 5), ("pdf", "- a\n* b\n• c\n1. d", 5), ("pdf", "x", 10001), ("docx", None, 5), ("xlsx", None, 5), ("pptx", "a", 5), ("pdf", "see Chart 1", 5), (None, "|", 1)]
    df = spark.createDataFrame(rows, "f string, t string, n int")
    got = [r[0] for r in df.select(content.layout_type(F.col("f"), F.col("t"), content.token_tier(F.col("n")))).collect()]
    assert got == ["narrative_text", "table", "visual_heavy", "longform_text", "empty", "spreadsheet", "presentation_slide", "visual_heavy", "narrative_text"]
    tiers = spark.createDataFrame([(5000,), (5001,), (10000,), (10001,)], "n int").select(content.token_tier(F.col("n")))
    assert [r[0] for r in tiers.collect()] == ["low", "medium", "medium", "high"]


def test_neighbours_and_order(spark):
    units = spark.createDataFrame([(1, f"{i}", i) for i in range(1, 11)] + [(1, "10.2", 10), (1, "10.10", 10)], "document_version_id bigint, content_unit_id string, page_number int")
    got = expand.neighbours(units, units.where("content_unit_id = '5'"), 2).collect()
    assert sorted(int(r["content_unit_id"]) for r in got) == [3, 4, 5, 6, 7]
    order = [r["content_unit_id"] for r in expand.numbered(units).orderBy("place").collect()]
    assert order[-3:] == ["10", "10.2", "10.10"]
    chunks = spark.createDataFrame([(1, "a", False, 0.2, "x"), (1, "a", True, 0.1, "a")], "document_version_id bigint, content_unit_id string, is_original boolean, score double, trigger string")
    assert tuple(expand.deduplicated(chunks).head())[2:4] == (True, 0.2)


def test_periods_and_names(spark):
    df = spark.createDataFrame([("Q1/26",), ("FY25",), ("QoQ change Q1 2026 vs Q4 2025",), (None,), ("As at  January 31",)], "p string")
    assert [r[0] for r in df.select(findings.canonical_period(F.col("p"))).collect()] == ["Q1 2026", "FY 2025", "QoQ change Q1 2026 vs Q4 2025", "", "As at January 31"]
    doc = spark.createDataFrame([("2026-q1",), ("q1-26",), (None,)], "p string")
    assert [r[0] for r in doc.select(findings.document_period(F.col("p"))).collect()] == ["Q1 2026", "Q1 2026", ""]
    names = spark.createDataFrame([("Common Equity Tier 1 (CET1) ratio",), ("CET1 ratio (%)",), ("CET1 ratio — prior quarter",), (None,)], "n string")
    assert [r[0] for r in names.select(findings.canonical_metric(F.col("n"))).collect()] == ["cet1 ratio"] * 3 + [""]
    tokens = spark.createDataFrame([("73 bps (+2 bps)",), ("1,090",), ("n/a",)], "v string")
    assert [r[0] for r in tokens.select(findings.value_tokens(F.col("v"))).collect()] == [["73 bps", "2 bps"], ["1090"], []]


def test_answers(spark):
    text = "## Summary\nA [1]. B! C [2]?\n## Other\nx\n## Gaps\n- one\n* two\n## Summary\nlast"
    df = spark.createDataFrame([(text,), (None,)], "t string")
    got = df.select(answers.answer_sections(F.col("t"))).collect()
    assert got[0][0] == {"summary": "last", "gaps": "- one\n* two"} and got[1][0] == {}
    gaps = spark.createDataFrame([("- one\n* two",), ("None identified",), (None,)], "g string").select(answers.gap_items(F.col("g"))).collect()
    assert [r[0] for r in gaps] == [["one", "two"], [], []]
    a = spark.createDataFrame([(1, "x [REF:1][REF:1] y [REF:9] z")], "k int, text string")
    refs = spark.createDataFrame([(1, 1, "f.pdf", 3)], "k int, ref_id int, filename string, page int")
    row = answers.linked_answers(a, refs, "k").head()
    assert row["text"] == 'x <a href="https://docs.local/files/f.pdf#page=3">[1]</a> y [REF:9] z'
    assert (row["used_refs"], row["unknown_refs"]) == ([1], [9])


def test_context_and_selection(spark):
    df = spark.createDataFrame([("src/2026/Q1/North/x/f.pdf",), ("f.pdf",), ("a/f.pdf",)], "p string").select(planning.path_context(F.col("p")).alias("c")).collect()
    assert [tuple(r["c"]) for r in df] == [("src", "2026", "Q1", "North/x"), ("", "", "", ""), ("a", "", "", "")]
    files = spark.createDataFrame([("/a/x.pdf", "x.pdf"), ("/a/y.txt", "y.txt")], "file_path string, filename string")
    assert files.where(planning.selected(globs=["*.pdf"])).count() == 1 and files.where(planning.selected(paths=["/a/y.txt"])).count() == 1


def test_diff(spark):
    s = "file_path string, file_size bigint, date_last_modified double, file_hash string"
    a = spark.createDataFrame([("n", 1, 1.0, ""), ("s", 2, 1.0, ""), ("h", 1, 2.0, "x"), ("m", 1, 2.0, "x"), ("u", 1, 1.0, "q")], s)
    b = spark.createDataFrame([("d", 1, 1.0, ""), ("s", 1, 1.0, ""), ("h", 1, 1.0, "x"), ("m", 1, 1.0, ""), ("u", 1, 1.0, "z")], s)
    got = {r["file_path"]: r["status"] for r in planning.catalog_diff(a, b).collect()}
    assert got == {"n": "new", "d": "deleted", "s": "modified", "h": "unchanged", "m": "modified", "u": "unchanged"}


def test_sheet(spark):
    text = "# Sheet: S\n\n| Row | B |\n| --- | --- |\n| 2 | x |\n| 3 | y |\n> chart\n| 4 | no |"
    row = content.sheet_chunks(spark.createDataFrame([(1, text)], "k int, t string"), ["k"], "t", 1).collect()
    assert [(r["chunk_no"], r["chunk_context"], r["n_rows"]) for r in row] == [(1, "Rows 2-2", 1), (2, "Rows 3-3", 1)]
    assert row[1]["chunk_text"] == "| 3 | y |\n> chart"


def test_merge_and_delete(spark):
    base = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, at int")
    out = store.merge_latest(base, spark.createDataFrame([("a", 2, 2), ("a", 3, 3), ("c", 1, 1), ("b", 9, 0)], base.schema), ["k"], "at")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 3), ("b", 1, 1), ("c", 1, 1)]
    assert store.without_keys(base.unionByName(spark.createDataFrame([(None, 0, 0)], base.schema)), base.where("k = 'a'"), "k").count() == 2
