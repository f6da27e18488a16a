import io
import zipfile

import pytest
from pyspark.sql import functions as F

from folioflow import providers
from folioflow.sources import exchange, files, office
from folioflow.streaming import answers as stream


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


XLSX = {
    "xl/workbook.xml": f'<workbook xmlns="{office.S[1:-1]}" xmlns:r="{office.R[1:-1]}"><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
    "xl/sharedStrings.xml": f'<sst xmlns="{office.S[1:-1]}"><si><t>a|b</t></si></sst>',
    "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{office.S[1:-1]}"><sheetData><row r="2"><c r="B2" t="s"><v>0</v></c><c r="AA2"><v>1.5</v></c></row></sheetData></worksheet>',
}


def test_workbook_formats_and_charts():
    ns, c, a = office.S[1:-1], office.C[1:-1], office.A[1:-1]
    point = lambda tag, *vs: f"<c:{tag}><c:x>" + "".join(f"<c:pt><c:v>{v}</c:v></c:pt>" for v in vs) + f"</c:x></c:{tag}>"
    parts = XLSX | {
        "xl/styles.xml": f'<styleSheet xmlns="{ns}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="165" formatCode="#,##0 &quot;days&quot;"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="10"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" s="1"><v>0.0523</v></c><c r="B1" s="2"><v>45658</v></c><c r="C1" s="3"><v>45658.5</v></c><c r="D1" s="4"><v>7</v></c><c r="E1" s="1"><v>1</v></c><c r="F1" s="99"><v>2</v></c></row></sheetData></worksheet>',
        "xl/worksheets/_rels/sheet1.xml.rels": '<Relationships><Relationship Id="d" Target="../drawings/drawing1.xml"/></Relationships>',
        "xl/drawings/drawing1.xml": "<x/>",
        "xl/drawings/_rels/drawing1.xml.rels": '<Relationships><Relationship Id="c" Target="/xl/charts/chart1.xml"/><Relationship Id="m" Target="../charts/chart9.xml"/></Relationships>',
        "xl/charts/chart1.xml": f'<c:chart xmlns:c="{c}" xmlns:a="{a}"><c:title><a:t>Income</a:t></c:title><c:ser>{point("tx", "CAD")}{point("cat", "Q1", "Q2", "Q3")}{point("val", 1.5, 2)}</c:ser><c:ser>{point("val", *range(20))}</c:ser></c:chart>',
    }
    page = office.read_xlsx(zipped(parts))[0].splitlines()
    assert page[4] == "| 1 | 5.23% | 2025-01-01 | 2025-01-01 12:00:00 | 7 | 100% | 2 |"
    assert page[6:8] == ["> Chart: Income", "> - CAD: Q1: 1.5; Q2: 2; Q3: "] and page[8] == "> - Series 2: " + "; ".join(f": {k}" for k in range(12))


def test_office():
    assert office.read_xlsx(zipped(XLSX)) == ["# Sheet: One\n\n| Row | B | AA |\n| --- | --- | --- |\n| 2 | a\\|b | 1.5 |"]
    w = office.W[1:-1]
    doc = f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>T</w:t></w:r></w:p><w:p><w:r><w:br w:type="page"/><w:t>x</w:t></w:r></w:p></w:body></w:document>'
    assert office.read_docx(zipped({"word/document.xml": doc})) == ["# T", "x"]
    a = office.A[1:-1]
    slide = f'<s xmlns:a="{a}"><a:p><a:r><a:t>Hello</a:t></a:r></a:p></s>'
    assert office.read_pptx(zipped({"ppt/slides/slide1.xml": slide})) == ["Hello"]


def test_scan_and_extract(spark, tmp_path):
    for path, data in (("src/2026/bank/a.XLSX", zipped(XLSX)), ("src/b.pdf", b"%PDF"), ("src/.hidden/c.pdf", b""), ("top.pdf", b""), ("src/d.xlsx", b"broken")):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    got = {r["filename"]: r for r in files.scan_files(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.XLSX", "b.pdf", "d.xlsx"}
    assert (got["a.XLSX"]["data_source"], got["a.XLSX"]["filter_1"], got["a.XLSX"]["filter_2"], got["a.XLSX"]["filetype"], got["a.XLSX"]["supported"]) == ("src", "2026", "bank", "xlsx", True)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "src"))
    pages = {r["file_path"].rpartition("/")[2]: (r["page_number"], r["error"] is None) for r in files.extract_pages(read.where("path not like '%hidden%'")).collect()}
    assert pages == {"a.XLSX": (1, True), "b.pdf": (0, False), "d.xlsx": (0, False)}


def test_dump_and_load(spark, tmp_path):
    ddl = "id bigint, t string, a array<string>, ok boolean"
    df = spark.createDataFrame([(1, "x\ty\n\\n", ["a", None], True), (None, None, None, None), (2, "", [], False)], ddl)
    exchange.dump_tables({"t": df}, str(tmp_path))
    assert sorted(map(str, exchange.load_table(spark, str(tmp_path), "t", ddl).collect())) == sorted(map(str, df.collect()))


def test_artifacts_and_traces(spark, tmp_path):
    df = spark.createDataFrame([(1, "text")], "document_version_id bigint, raw_content string")
    exchange.write_artifacts(df, "chunking", str(tmp_path / "a"))
    assert exchange.read_artifacts(spark, str(tmp_path / "a"), "chunking", "document_version_id bigint, raw_content string").head()["raw_content"] == "text"
    bad = exchange.artifact_rows(df, "chunking").withColumn("checksum", F.lit("no"))
    bad.write.mode("overwrite").partitionBy("stage_name").json(str(tmp_path / "a"))
    with pytest.raises(Exception, match="checksum"):
        exchange.read_artifacts(spark, str(tmp_path / "a"), "chunking", "document_version_id bigint, raw_content string").collect()
    with pytest.raises(FileNotFoundError):
        exchange.safe_trace("../x")
    assert exchange.safe_trace(exchange.trace_id("2026-01-01T10:00:00Z", "q"))


def test_stream_links(spark, tmp_path):
    rows = [("r", 0, "a [RE", False), ("r", 1, "F:1] b [REF:7] [R", False), ("r", 2, "EF:1", True)]
    src = tmp_path / "in"
    spark.createDataFrame(rows, "response_id string, seq bigint, text string, is_last boolean").coalesce(1).write.json(str(src))
    chunks = spark.readStream.schema("response_id string, seq bigint, text string, is_last boolean").json(str(src))
    q = stream.stream_links(chunks, {1: ("f.pdf", 2)}).writeStream.format("memory").queryName("links").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    text = "".join(r["text"] for r in spark.table("links").orderBy("seq").collect())
    assert text == 'a <a href="https://docs.local/files/f.pdf#page=2">[1]</a> b [REF:7] [REF:1'


def test_providers(spark):
    df = spark.createDataFrame([(1, "# A\nx\n# B"), (2, "# A\nx\n# B"), (3, None)], "k int, p string")
    got = {r["k"]: r["answer"]["breakpoints"] for r in providers.answers(df, "p", "markdown_chunking").collect()}
    assert got == {1: [1, 3], 2: [1, 3], 3: []}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError
        return "ok"

    assert providers.with_retry(flaky, pause=0) == "ok"
    vectors = providers.embedded(spark.createDataFrame([("a b",), ("",), (None,)], "t string"), "t").collect()
    assert len(vectors[0]["vector"]) == 64 and vectors[1]["vector"] is None and vectors[2]["vector"] is None
