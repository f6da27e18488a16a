"""Stage runs, the writer lock, research rounds, sheet context and PDF pages."""

import zlib

import pytest
from pyspark.sql import functions as F

from folioflow import engine
from folioflow.operators import content, research, sheets, stages
from folioflow.sources.pdf import read_pdf

SIGNATURES = {"one": "s1", "two": "s2"}


def test_a_failed_stage_is_taken_up_and_a_new_signature_runs_on_from_it(spark, tmp_path):
    calls, broken = [], [True]

    def one(df):
        calls.append("one")
        return df.withColumn("v", F.col("v") + 1)

    def two(df):
        calls.append("two")
        if broken[0]:
            raise RuntimeError("executor lost")
        return df.withColumn("v", F.col("v") * 10)

    source = spark.createDataFrame([(1, 1), (2, None), (None, 3)], "document_version_id bigint, v int")
    make = lambda signatures: stages.StageRun(spark, str(tmp_path / "run"), [("one", one), ("two", two)], signatures)
    with pytest.raises(RuntimeError):
        make(SIGNATURES).run(source)
    states = {(r["stage_name"], r["status"], r["error_message"]) for r in make(SIGNATURES).log().collect()}
    assert states == {("one", "running", ""), ("one", "succeeded", ""), ("two", "running", ""), ("two", "failed", "RuntimeError: executor lost")}
    broken[0] = False
    got = make(SIGNATURES).run(source)
    assert calls == ["one", "two", "two"] and sorted(str(r["v"]) for r in got.collect()) == ["20", "40", "None"]
    make(SIGNATURES).run(source)
    make(SIGNATURES | {"two": "s3"}).run(source)
    assert calls == ["one", "two", "two", "two"]
    # a damaged artifact is made again, and what comes after it
    path = make(SIGNATURES)._usable("one")
    spark.createDataFrame([(1, 99)], "document_version_id bigint, v int").write.mode("overwrite").parquet(path)
    assert sorted(str(r["v"]) for r in make(SIGNATURES).run(source).collect()) == ["20", "40", "None"]
    assert calls[-2:] == ["one", "two"]


def test_writer_lock(spark, tmp_path):
    now = [1000.0]
    a, b = (stages.WriterLock(spark, str(tmp_path), 60, lambda: now[0]) for _ in range(2))
    assert a.acquire() and not b.acquire()
    now[0] += 50
    assert a.heartbeat() and not b.heartbeat()
    now[0] += 50
    assert not b.acquire()
    now[0] += 61
    assert b.acquire() and not a.heartbeat()
    a.release()
    assert b.heartbeat()
    b.release()
    assert a.acquire()


def test_wiped_tables_keep_their_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id bigint, x string").write.parquet(path)
    assert stages.wiped(spark, {"t": path}) == {"t": 1}
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id", "x"]


def test_research_rounds(spark):
    rows = [(1, 1, ["a"], 0.5, 2), (1, 2, [" A "], 0.5, 2), (1, 3, ["x"], 0.9, 1), (2, 1, ["a"], 0.5, 1), (2, 2, ["a"], 0.6, 1), (2, 3, ["b"], 0.1, 1), (3, 1, None, None, None), (4, 1, ["a"], 0.1, 0)]
    got = research.loop_rounds(spark.createDataFrame(rows, "k int, iteration int, queries array<string>, confidence double, new_chunks int"), "k").collect()
    assert sorted((r["k"], r["iteration"], str(r["stop_reason"])) for r in got) == [
        (1, 1, "None"), (1, 2, research.REPEATED), (2, 1, "None"), (2, 2, "None"), (2, 3, research.MOST_ROUNDS), (3, 1, research.NO_QUERIES), (4, 1, research.NOTHING_NEW)
    ]


def test_follow_up_stops_for_its_reasons(spark):
    texts = ["net interest margin rose", "liquidity coverage fell", "deposit volumes grew"]
    pages = spark.createDataFrame(
        [(i + 1, 1, i + 1, t, "", "", "", "", [], [], 5) for i, t in enumerate(texts)],
        "page_result_id bigint, document_version_id bigint, page_number int, raw_content string, chunk_id string, section_id string, chunk_context string, chunk_header string, keywords array<string>, entities array<string>, token_count int",
    )
    found = engine.document_content(pages)
    asked = lambda *t: spark.createDataFrame([(1, x) for x in t], "query_id int, text string")
    options = engine.Options(top_k=1, text_top_k=1, candidates=1)
    reasons = []
    ask = {0: (asked("liquidity coverage"), 0.5), 1: (asked("Liquidity coverage "), 0.5)}
    seen = engine.follow_up(found, asked("net interest margin"), lambda n, _: ask[n], options, reasons.append)
    assert reasons == [research.REPEATED] and seen.count() == 2
    engine.follow_up(found, asked("net interest margin"), lambda n, _: (None, 1.0), options, reasons.append)
    engine.follow_up(found, asked("net interest margin"), lambda n, _: (asked("interest margin net"), 0.1), options, reasons.append)
    assert reasons[1:] == [research.NO_QUERIES, research.NOTHING_NEW]


def test_sheet_context(spark):
    text = "# S\n| Row | A |\n| --- | --- |\n| 1 | unit |\n| 2 | unit |\n| 3 | head |\n| 4 | x |\n| 5 | y |\n> chart"
    pages = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    rows = sheets.context_chunks(pages, ["id"], "t", lambda _: F.array(F.lit(4), F.lit(5), F.lit(99)), lambda _: F.array(F.lit(1), F.lit(2)), lambda _: F.array(F.array(F.lit(3), F.lit(4)), F.array(F.lit(3)))).orderBy("chunk_no").collect()
    assert [r["chunk_context"] for r in rows] == ["Rows 1-3", "Rows 4-4", "Rows 5-5"]
    assert {r["sheet_passthrough"] for r in rows} == {"| Row | A |\n| --- | --- |\n| 1 | unit |"}
    assert [r["section_passthrough"] for r in rows] == ["", "| 3 | head |", "| 3 | head |"]
    assert rows[-1]["chunk_text"] == "| 5 | y |\n\n> chart"


def test_extracted_units_need_an_id_each(spark):
    pages = spark.createDataFrame([(1, "", 7, ["old"], None), (1, "7.1", 7, None, None), (2, None, 1, None, None)], "document_version_id int, chunk_id string, page_number int, keywords array<string>, entities array<string>")
    said = spark.createDataFrame(
        [(1, '{"items":[{"unit_id":"7","keywords":["a"],"entities":[]},{"unit_id":"7.1","keywords":["b"],"entities":["E"]}],"rationale":""}'), (2, '{"items":[{"unit_id":"1","keywords":["x"],"entities":[]},{"unit_id":"1","keywords":[],"entities":[]}],"rationale":""}')],
        "document_version_id int, payload string",
    )
    got = sorted((r["document_version_id"], str(r["chunk_id"]), r["keywords"], r["entities"]) for r in content.extracted_units(pages, said).collect())
    assert got == [(1, "", ["a"], []), (1, "7.1", ["b"], ["E"]), (2, "None", [], [])]


def pdf(pages, compressed=True, cmap=None):
    """A small PDF file, one content stream a page."""
    out = [b"%PDF-1.4"]

    def add(number, body):
        out.append(b"%d 0 obj\n%s\nendobj" % (number, body))

    def stream(data):
        packed = zlib.compress(data) if compressed else data
        return b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(packed), b" /Filter /FlateDecode" if compressed else b"", packed)

    kids = b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(len(pages)))
    add(1, b"<< /Type /Catalog /Pages 2 0 R >>")
    add(2, b"<< /Type /Pages /Kids [%s] /Count %d /Resources << /Font << /F1 3 0 R >> >> >>" % (kids, len(pages)))
    add(3, b"<< /Type /Font /Subtype /Type1%s >>" % (b" /ToUnicode 4 0 R" if cmap else b""))
    if cmap:
        add(4, stream(cmap))
    for k, content_ in enumerate(pages):
        add(10 + 2 * k, b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * k))
        add(11 + 2 * k, stream(content_))
    return b"\n".join([*out, b"trailer << /Root 1 0 R >>\n%%EOF"])


@pytest.mark.parametrize("compressed", [True, False])
def test_pdf_pages(compressed):
    pages = [b"BT /F1 12 Tf 50 700 Td (Net \\(interest\\) margin) Tj 0 -14 Td [(CET1)-250(ratio \\351)] TJ ET", b"BT /F1 9 Tf <48656C6C6F> Tj T* (two) Tj ET", b""]
    assert read_pdf(pdf(pages, compressed)) == ["Net (interest) margin\nCET1 ratio é", "Hello\ntwo", ""]


def test_pdf_unicode_map_and_errors():
    cmap = b"1 beginbfchar <0001> <03A9> endbfchar 1 beginbfrange <0002> <0003> <0041> endbfrange"
    assert read_pdf(pdf([b"BT /F1 12 Tf <000100020003> Tj ET"], cmap=cmap)) == ["ΩAB"]
    for bad in (b"", b"no pdf", b"%PDF-1.4 trailer << /Encrypt 5 0 R >>", b"%PDF-1.4 broken"):
        with pytest.raises(ValueError):
            read_pdf(bad)
    with pytest.raises(ValueError):
        read_pdf(pdf([b""], False).replace(b"/Length 0", b"/Filter /DCTDecode"))


def test_service(spark, data, tmp_path):
    import json
    import threading
    import urllib.error
    import urllib.request

    from folioflow.service import server

    suite = tmp_path / "suite.json"
    suite.write_text(json.dumps({"queries": [{"name": "a", "query": "what?"}]}))
    s = server(spark, data, str(tmp_path / "traces"), str(suite))
    threading.Thread(target=s.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{s.server_address[1]}/api"
    try:
        get = lambda path: json.loads(urllib.request.urlopen(base + path).read())
        assert get("/test-queries") == [{"name": "a", "query": "what?"}]
        banks = get("/banks-periods")
        assert banks and banks == sorted(banks, key=lambda b: b["bank"]) and banks[0]["periods"] == sorted(banks[0]["periods"], reverse=True)
        body = json.dumps({"query": "net interest margin"}).encode()
        events = urllib.request.urlopen(urllib.request.Request(base + "/query", data=body)).read().decode().strip().split("\n\n")
        assert events[0].startswith("event: chunk\ndata: ") and events[-1].startswith("event: result")
        trace = json.loads(events[-1].partition("data: ")[2])["trace_id"]
        assert get(f"/trace/{trace}")[0]["query"] == "net interest margin"
        assert urllib.request.urlopen(urllib.request.Request(base + "/query", data=b"{}")).read().startswith(b"event: error")
        for path, data_, status in (("/trace/../x", None, 404), ("/trace/20260101T000000Z_00000000", None, 404), ("/nothing", None, 404), ("/query", b"[]", 400)):
            with pytest.raises(urllib.error.HTTPError) as e:
                urllib.request.urlopen(urllib.request.Request(base + path, data=data_))
            assert e.value.code == status
    finally:
        s.shutdown()
        s.server_close()


def test_prompts(spark, tmp_path):
    from folioflow import providers

    path = tmp_path / "p.json"
    path.write_text('{"rerank": {"system": "s", "user": "Rank {query}", "fields": ["query"]}}')
    assert providers.prompt_book(str(path))["rerank"]["user"] == "Rank {query}"
    for bad in ('{"no_stage": {"system": "s", "user": "u"}}', '{"rerank": {"system": "s", "user": ""}}', '{"rerank": {"system": "s", "user": "{x}", "fields": []}}'):
        path.write_text(bad)
        with pytest.raises(ValueError):
            providers.prompt_book(str(path))
