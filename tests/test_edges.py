"""NULLs, empty tables, ties, repeated rows and clashing names in the operators of runs, answers, search and content."""

from pyspark.sql import functions as F

from folioflow.operators import content, fusion, lexical, research, sheets, stages
from folioflow.providers import rendered
from folioflow.streaming.answers import events, split_tail


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_text_matches(spark):
    texts = spark.createDataFrame([(1, "Net  interest, margin!", 9), (2, None, 9), (3, "", 9), (4, "margin net interest", 9), (4, "margin net interest", 9), (None, "liquidity", 9)], "id int, t string, query_id int")
    asked = spark.createDataFrame([(1, '"net interest margin" OR liquidity'), (2, None), (3, '""'), (4, "NET OR interest")], "query_id int, query_text string")
    assert rows(lexical.text_matches(texts, asked, "id", "t"), "query_id", "id", "n_matched") == sorted([(1, 1, 1), (1, None, 1), (4, 1, 2), (4, 4, 2), (4, 4, 2)], key=str)
    assert lexical.text_matches(texts, asked.limit(0), "id", "t").count() == 0


def test_bm25_against_brute_force(spark):
    import math

    docs = [(1, "a b a c"), (2, "b b d"), (3, None), (4, ""), (5, "A! é a"), (None, "a a a")]
    asked = [(7, ["a", "b", "a"]), (8, ["zz"]), (None, ["a"]), (9, [])]
    df = spark.createDataFrame(docs, "id int, t string").withColumn("query_id", F.lit(1))
    got = {(r["query_id"], r["id"]): (r["score"], r["rank"]) for r in lexical.bm25(df, spark.createDataFrame(asked, "query_id int, terms array<string>"), "id", "t", None).collect()}
    known = [(i, (t or "").lower().replace("!", "").replace("é", "").split()) for i, t in docs if i is not None]
    n, mean = len(known), sum(len(w) for _, w in known) / len(known)
    want = {}
    for i, w in known:
        score = 0.0
        for term in ("a", "b"):
            df_, tf = sum(term in x for _, x in known), w.count(term)
            score += math.log(1 + (n - df_ + 0.5) / (df_ + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        if score:
            want[7, i] = score
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k]) < 1e-9 for k in want)
    assert sorted(rank for _, rank in got.values()) == [1, 2, 3]


def test_hot_queries_are_fused_alike(spark):
    data = [(q, s, sub, f"u{u}", float(u) if s == "bm25" else None, None if s == "bm25" else u / 10) for q in (1, 2) for s in ("bm25", "subquery_vector") for sub in (None, 1) for u in range(6)]
    data += [(1, "bm25", None, "u1", 99.0, None), (1, "bm25", None, "u2", None, None), (2, "unknown", None, "u9", 1.0, None), (None, "bm25", None, "u", 1.0, None), (1, None, None, "u", 1.0, None), (1, "bm25", None, None, 1.0, None)]
    hits = spark.createDataFrame(data, "query_id int, strategy string, sub_query int, content_unit_id string, score double, distance double").withColumn("unit", F.lit("x"))
    shown = lambda df: rows(df.withColumn("score", F.round("score", 9)), "query_id", "content_unit_id", "score", "position")
    usual = shown(fusion.ranked(fusion.fused(hits, hot=None), hot=None))
    assert usual == shown(fusion.ranked(fusion.fused(hits, hot=hits.where("query_id = 1").select("query_id").distinct()))) and len(usual) == 13
    assert fusion.hot_queries(hits, hot_rows=5).count() == 2 and fusion.hot_queries(hits) is None
    assert fusion.fused(hits.limit(0)).count() == 0


def test_judge(spark):
    c = spark.createDataFrame([(q, f"u{p}", p) for q in (1, 2, 3) for p in (1, 2, 3)], "query_id int, content_unit_id string, position int")
    removed = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (1, 99), (3, None)], "query_id int, position int")
    assert rows(fusion.kept_by_judge(c, removed, 2), "query_id", "position", "restored") == [(1, 1, True), (1, 3, False), *[(q, p, False) for q in (2, 3) for p in (1, 2, 3)]]
    assert rows(fusion.kept_by_judge(c, removed, 9).where("query_id = 1"), "position") == [(3,)]


def test_final_answers(spark):
    units = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (None, "x")], "document_version_id int, text string")
    f = spark.createDataFrame([(1, 5, 1, "p", None), (1, 6, 1, "p", "again"), (1, 7, 2, None, "b"), (3, 8, 1, "p", "c")], "document_version_id int, finding_id int, page int, location_detail string, finding string")
    write = lambda i: i.select("document_version_id", F.concat(F.lit("## Summary\n"), F.col("inventory"), F.lit("\n## Gaps\nNone identified.")).alias("text"))
    got = {r["document_version_id"]: r for r in research.final_answers(units, units.where("document_version_id < 3"), f, write).collect()}
    assert got[1]["summary_answer"] == "[REF:1] \n[REF:2] b" and got[1]["data_gaps"] == [] and got[1]["n_references"] == 2
    assert got[2]["data_gaps"] == [research.NO_FINDINGS] and got[2]["response"] == ""
    assert got[3]["data_gaps"] == [research.NO_SOURCES] and got[None]["data_gaps"] == [research.NO_SOURCES]
    assert research.final_answers(units.limit(0), units, f, write).count() == 0


def test_stages(spark):
    c = spark.createDataFrame([("a", "X"), ("a", None), (None, "x"), ("b", "x"), ("", "x")], "artifact_path string, artifact_checksum string")
    there = spark.createDataFrame([("a", "x"), ("", "x")], "artifact_path string, checksum string")
    assert rows(stages.verified(c, there), "artifact_path", "artifact_checksum", "artifact_ok") == sorted([("a", "X", True), ("a", None, False), (None, "x", False), ("b", "x", False), ("", "x", False)], key=str)
    names = spark.createDataFrame([("g", "1"), ("g", "3"), ("g", None), (None, "2")], "g string, n string")
    assert rows(stages.retained(names, ["g"], "n", 1).where("kept"), "g", "n") == [("g", "3"), (None, "2")]
    ids = stages.fresh_ids(spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "x string"), 10, ["x"])
    assert rows(ids, "id") == [(11,), (12,), (13,), (14,)] and [r["x"] for r in ids.orderBy("id").collect()] == [None, "a", "a", "b"]
    one, two = (spark.createDataFrame(d, "a int, b string").agg(stages.row_checksum(["a", "b"])).head()[0] for d in ([(1, None), (2, "x")], [(2, "x"), (1, None)]))
    assert one == two != spark.createDataFrame([(1, None)], "a int, b string").agg(stages.row_checksum(["a", "b"])).head()[0]


def test_content(spark):
    p = spark.createDataFrame([(None, None), ("t", [("A", "x"), (None, "y"), ("B", None)]), ("", [])], "t string, r array<struct<title:string,content:string>>")
    assert rows(p.select(content.page_with_regions(F.col("t"), F.col("r")).alias("x")), "x") == [("",), ("",), ("t\n\n## A\nx\n\n## Region\ny",)]
    b = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (0.5, 0.5, 0.4, 0.9), (None, 0.1, 0.2, 0.3)], "x1 double, y1 double, x2 double, y2 double")
    assert [r["b"] is not None for r in b.select(content.padded_box(*[F.col(c) for c in b.columns]).alias("b")).collect()] == [True, False, False]
    v = spark.createDataFrame([(1, "f", "XLSX"), (2, "g", None), (None, None, None)], "id int, filename string, filetype string")
    said = spark.createDataFrame([(1, ("T", None, "sections", None)), (2, (None, "en", None, True))], "id int, answer struct<title:string,language:string,structure_type:string,has_toc:boolean>")
    assert rows(content.document_metadata(v, said), "id", "title", "structure_type", "has_toc") == [(1, "T", "sheet_based", False), (2, "g", "", True), (None, None, "", False)]
    assert sheets.prompts(spark.createDataFrame([(1, None), (2, "no rows")], "id int, t string"), ["id"], "t").count() == 0


def test_marks_and_prompts_and_events(spark):
    assert [split_tail(t) for t in ("a [RE", "a [REF:12", "a [REF:", "a [", "a [x", "a [REF:1]", "", "[REF:1x")] == [
        ("a ", "[RE"), ("a ", "[REF:12"), ("a ", "[REF:"), ("a ", "["), ("a [x", ""), ("a [REF:1]", ""), ("", ""), ("[REF:1x", "")
    ]
    df = spark.createDataFrame([(1, "{a}", None)], "k int, a string, b string")
    assert df.select(rendered("x {a} {b}{a}!", {"a": F.col("a"), "b": F.col("b")}).alias("p")).head()[0] == "x {a} {a}!"
    chunks = spark.createDataFrame([(1, 1, "a", False, None), (1, 2, None, False, None), (1, 3, None, True, ""), (2, 1, "x", True, "bad")], "response_id int, seq int, text string, is_last boolean, error string")
    assert rows(events(chunks), "response_id", "seq", "event") == [(1, 1, "chunk"), (1, 3, "result"), (2, 1, "error")]
