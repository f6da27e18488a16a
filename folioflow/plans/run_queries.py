"""Queries of runs, research rounds, answers, sheet context and enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow import providers
from folioflow.operators import content, findings, fusion, lexical, planning, research, sheets, stages, vector
from folioflow.plans.answer_queries import _CELLS, _GROUPS
from folioflow.plans.answer_queries import _groups as metric_records
from folioflow.plans.content_queries import _SHEETS, _STARTS
from folioflow.plans.search_queries import _NORMAL, _TOPK, _vectors
from folioflow.plans.store_queries import _USABLE
from folioflow.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_NONE = "CAST([] AS VARCHAR[])"


@query(
    """SELECT document_version_id, page_number, count(*) FILTER (coalesce(raw_token_count, 0) > 100 AND lower(coalesce(layout_type, '')) NOT IN ('legend', 'list')) AS n_regions
FROM page_results GROUP BY 1, 2"""
)
def regions_to_extract(spark, d):
    """the units of a page as its regions; long ones ask for a reading of their own, legends and lists are skipped."""
    region = F.struct(F.col("layout_type").alias("region_type"), (F.coalesce("raw_token_count", F.lit(0)) > 100).alias("requires_region_extraction"))
    pages = table(spark, d, "page_results").groupBy("document_version_id", "page_number").agg(F.collect_list(region).alias("regions"))
    return pages.select("document_version_id", "page_number", F.size(content.regions_to_extract(F.col("regions"), ("legend", "list"))).cast("bigint").alias("n_regions"))


@query(
    """SELECT page_result_id, size, sha256(CASE WHEN length(raw_content) > size * 4 THEN left(raw_content, size * 4) || '...' ELSE raw_content END) AS digest
FROM page_results, (SELECT unnest([150, 75, 50]) AS size) WHERE raw_content IS NOT NULL"""
)
def preview_attempts(spark, d):
    """The previews of each attempt, ever shorter."""
    pages = table(spark, d, "page_results").where(F.col("raw_content").isNotNull())
    sizes = F.explode(F.array(*[F.lit(n) for n in content.preview_sizes(150)])).alias("size")
    # a substring's length may be a column
    return pages.select("page_result_id", "raw_content", sizes).select(
        "page_result_id", "size", F.sha2(F.when(F.length("raw_content") > F.col("size") * 4, F.concat(F.substring("raw_content", F.lit(1), F.col("size") * 4), F.lit("..."))).otherwise(F.col("raw_content")), 256).alias("digest")
    )


@query(
    r"""WITH l AS (SELECT page_result_id, list_transform(regexp_split_to_array(coalesce(raw_content, ''), '\r\n|\r|\n'), lambda x: len(regexp_extract_all(x, '[^ \t\r\n]+'))) AS n FROM page_results)
SELECT page_result_id, list_sum(n)::BIGINT AS n_tokens, 0::BIGINT AS n_over FROM l WHERE list_max(n) <= 2000"""
)
def chunks_within_limit(spark, d):
    """Pages split at headings and, where a piece is beyond 2,000 tokens, again; no token is lost and no piece is over. A page with a longer line is an error, so it is not asked for."""
    lines = F.split(F.coalesce("raw_content", F.lit("")), r"\r\n|\r|\n")
    pages = table(spark, d, "page_results").where(F.array_max(F.transform(lines, content.word_count)) <= 2000)
    pieces = content.chunks_within(pages, ["page_result_id"], "raw_content", 2000)
    return pieces.groupBy("page_result_id").agg(F.sum("token_count").cast("bigint").alias("n_tokens"), F.count_if(F.col("token_count") > 2000).alias("n_over"))


_CONTEXT = _SHEETS + r""", s AS (SELECT *, coalesce(sum(CASE WHEN i > 1 AND row_no % 40 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY page_result_id ORDER BY i), 0) AS seg,
  trim(regexp_replace(line, '^[^|]*\|[^|]*\|', ''), ' ') AS cells FROM r),
b AS (SELECT page_result_id, list_sort(list(DISTINCT row_no) FILTER (row_no % 40 = 0)) AS breaks FROM r GROUP BY 1),
h AS (SELECT page_result_id, arg_min(line, no) FILTER (line LIKE '| Row |%') AS header, arg_min(line, no) FILTER (line LIKE '| ---%') AS rule FROM x GROUP BY 1),
p AS (SELECT page_result_id, string_agg(line, chr(10) ORDER BY i) AS carried FROM (SELECT page_result_id, cells, min(i) AS i, arg_min(line, i) AS line FROM s WHERE row_no <= 2 GROUP BY 1, 2) GROUP BY 1),
w AS (SELECT page_result_id, row_no, arg_max(line, i) AS line FROM s GROUP BY 1, 2),
g AS (SELECT page_result_id, seg, list(line ORDER BY i) AS own, arg_min(row_no, i) AS lo, arg_max(row_no, i) AS hi FROM s GROUP BY 1, 2)"""


@query(
    f"""WITH {_CONTEXT} SELECT g.page_result_id, (g.seg + 1)::INT AS chunk_no, 'Rows ' || lo || '-' || hi AS chunk_context,
sha256(CASE WHEN carried IS NULL THEN '' ELSE concat_ws(chr(10), header, rule, carried) END) AS sheet_digest,
sha256(CASE WHEN g.seg > 0 AND w.line IS NOT NULL AND NOT list_contains(own, w.line) THEN w.line ELSE '' END) AS section_digest
FROM g JOIN b USING (page_result_id) JOIN h USING (page_result_id) LEFT JOIN p USING (page_result_id) LEFT JOIN w ON w.page_result_id = g.page_result_id AND g.seg > 0 AND w.row_no = b.breaks[g.seg::INT] - 1"""
)
def sheet_context(spark, d):
    """C11: sheets cut at every row number that 40 divides; all chunks carry the first rows, each the row before its break."""
    def breaks(parts):
        return F.array_sort(F.array_distinct(F.filter(F.transform(parts["rows"], lambda r: r["row_no"]), lambda n: n % 40 == 0)))

    chunks = sheets.context_chunks(
        table(spark, d, "page_results"), ["page_result_id"], "raw_content", breaks, lambda _: F.array(F.lit(0), F.lit(1), F.lit(2)), lambda parts: F.transform(breaks(parts), lambda n: F.array(n - 1))
    )
    return chunks.select("page_result_id", "chunk_no", "chunk_context", F.sha2("sheet_passthrough", 256).alias("sheet_digest"), F.sha2("section_passthrough", 256).alias("section_digest"))


@query(
    f"""WITH {_SHEETS}, o AS (SELECT page_result_id, list(line ORDER BY i) AS ls FROM r GROUP BY 1), k AS (SELECT *, unnest(range(0, (len(ls) + 49) // 50)) AS i FROM o)
SELECT page_result_id, (i + 1)::INT AS batch_no, sha256(array_to_string(ls[1:5] || CASE WHEN i > 0 THEN ls[i * 50 - 2:i * 50] ELSE {_NONE} END || ls[i * 50 + 1:i * 50 + 50], chr(10))) AS digest FROM k"""
)
def sheet_prompts(spark, d):
    """Batches of rows with the sheet's first five and the last three before them."""
    return sheets.prompts(table(spark, d, "page_results"), ["page_result_id"], "raw_content").select("page_result_id", "batch_no", F.sha2("prompt", 256).alias("digest"))


@query(
    f"""WITH {_SHEETS}, c AS (SELECT *, trim(regexp_replace(line, '^[^|]*\\|[^|]*\\|', ''), ' ') AS cells FROM r)
SELECT page_result_id, count(DISTINCT cells)::INT AS n_distinct FROM c GROUP BY 1"""
)
def distinct_sheet_rows(spark, d):
    """Rows whose cells, without the row's number, no row before them has."""
    p = table(spark, d, "page_results").select("page_result_id", content.sheet_parts(F.col("raw_content")).alias("s")).where(F.size("s.rows") > 0)
    return p.select("page_result_id", F.size(sheets.first_by_cells(F.col("s.rows.line"))).alias("n_distinct"))


_UNITS_SAID = """u AS (SELECT *, coalesce(nullif(chunk_id, ''), page_number::VARCHAR) AS unit FROM page_results),
f AS (SELECT document_version_id, unit, arg_min(coalesce(keywords, []), page_result_id) AS k, arg_min(coalesce(entities, []), page_result_id) AS e FROM u GROUP BY 1, 2)"""


@query(f"WITH {_UNITS_SAID} SELECT page_result_id, coalesce(array_to_string(f.k, ';'), '') AS keywords, coalesce(array_to_string(f.e, ';'), '') AS entities FROM u LEFT JOIN f ON f.document_version_id = u.document_version_id AND f.unit = u.unit")
def content_extraction(spark, d):
    """Keywords and entities of each unit from one JSON answer for each document."""
    pages = table(spark, d, "page_results")
    none = F.array().cast("array<string>")
    unit = F.coalesce(F.nullif(F.col("chunk_id"), F.lit("")), F.col("page_number").cast("string"))
    items = pages.groupBy("document_version_id", unit.alias("unit_id")).agg(F.min_by(F.struct(F.coalesce("keywords", none).alias("keywords"), F.coalesce("entities", none).alias("entities")), "page_result_id").alias("s"))
    said = items.groupBy("document_version_id").agg(F.collect_list(F.struct("unit_id", "s.keywords", "s.entities")).alias("items"))
    said = said.select("document_version_id", F.to_json(F.struct("items", F.lit("").alias("rationale"))).alias("payload"))
    told = content.extracted_units(pages, said)
    return told.select("page_result_id", F.array_join("keywords", ";").alias("keywords"), F.array_join("entities", ";").alias("entities"))


@query(
    """SELECT id, filename AS title, CASE WHEN id % 2 = 0 THEN 'en' ELSE '' END AS language, CASE WHEN lower(filetype) = 'xlsx' THEN 'sheet_based' WHEN id % 2 = 0 THEN 'sections' ELSE '' END AS structure_type, false AS has_toc FROM document_versions"""
)
def document_metadata(spark, d):
    """C20: every second version has an answer, with a blank title."""
    v = table(spark, d, "document_versions")
    said = v.where("id % 2 = 0").select("id", F.struct(F.lit(" ").alias("title"), F.lit("en").alias("language"), F.lit("sections").alias("structure_type"), F.lit(False).alias("has_toc")).alias("answer"))
    return content.document_metadata(v, said)


@query(f"WITH {_STARTS} SELECT document_version_id, string_agg(title || '@' || page_start, '; ' ORDER BY page_start, no) AS toc FROM sec GROUP BY 1")
def generated_toc(spark, d):
    """C19"""
    toc = content.toc_entries(content.section_ranges(content.section_starts(table(spark, d, "page_results"))).withColumn("summary", F.lit("")))
    return toc.select("document_version_id", F.array_join(F.transform("toc", lambda e: F.concat(e["name"], F.lit("@"), e["page_number"].cast("string"))), "; ").alias("toc"))


@query(
    f"""WITH {_STARTS}, o AS (SELECT s.document_version_id, s.no, p.page_number, coalesce(p.token_count, 0) AS t FROM sec s JOIN page_results p ON p.document_version_id = s.document_version_id AND p.page_number BETWEEN s.page_start AND s.page_end),
big AS (SELECT document_version_id, no FROM o GROUP BY 1, 2 HAVING sum(t) > 15000), q AS (SELECT DISTINCT o.document_version_id, o.no, o.page_number FROM o JOIN big USING (document_version_id, no))
SELECT document_version_id, no::VARCHAR AS parent_section_id, no || '.' || row_number() OVER (PARTITION BY document_version_id, no ORDER BY page_number) AS section_id, page_number FROM q"""
)
def large_subsections(spark, d):
    """The pages of sections beyond 15,000 tokens."""
    p = table(spark, d, "page_results")
    return content.large_subsections(content.section_ranges(content.section_starts(p)), p)


@query(
    """WITH b AS (SELECT page_result_id, page_number % 10 / 10.0 AS x1, page_number % 7 / 10.0 AS y1, (page_number % 10 + 2) / 10.0 AS x2, (page_number % 5 + 3) / 10.0 AS y2 FROM page_results)
SELECT page_result_id, round(greatest(0, x1 - 0.025), 6)::DOUBLE AS x1, round(greatest(0, y1 - 0.025), 6)::DOUBLE AS y1, round(least(1, x2 + 0.025), 6)::DOUBLE AS x2, round(least(1, y2 + 0.025), 6)::DOUBLE AS y2
FROM b WHERE x1 >= 0 AND x1 < x2 AND x2 <= 1 AND y1 >= 0 AND y1 < y2 AND y2 <= 1"""
)
def padded_boxes(spark, d):
    """Crop boxes with their margin."""
    n = F.col("page_number")
    box = content.padded_box(n % 10 / 10.0, n % 7 / 10.0, (n % 10 + 2) / 10.0, (n % 5 + 3) / 10.0)
    b = table(spark, d, "page_results").select("page_result_id", box.alias("b")).where(F.col("b").isNotNull())
    return b.select("page_result_id", *[F.round(F.col(f"b.{c}"), 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(
    """SELECT page_result_id, sha256(concat_ws(chr(10) || chr(10), nullif(coalesce(raw_content, ''), ''), CASE WHEN coalesce(chunk_header, '') <> '' THEN '## ' || coalesce(layout_type, 'Region') || chr(10) || chunk_header END)) AS digest FROM page_results"""
)
def pages_with_regions(spark, d):
    """Text and region contents of a page as one."""
    regions = F.array(F.struct(F.col("layout_type").alias("title"), F.col("chunk_header").alias("content")))
    return table(spark, d, "page_results").select("page_result_id", F.sha2(content.page_with_regions(F.col("raw_content"), regions), 256).alias("digest"))


_ASKED = [(1, '"net interest margin" OR liquidity'), (2, '"CET1 ratio"'), (3, '"deposit volumes" OR "interest net"'), (4, "basis OR Stage"), (5, '""')]


@query(
    r"""WITH q(query_id, a) AS (VALUES (1, ' net interest margin '), (1, ' liquidity '), (2, ' cet1 ratio '), (3, ' deposit volumes '), (3, ' interest net '), (4, ' basis '), (4, ' stage ')),
t AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+'), ' ') || ' ' AS own FROM documents)
SELECT query_id, doc_id, count(*)::INT AS n_matched FROM t JOIN q ON contains(own, a) GROUP BY ALL"""
)
def text_matches(spark, d):
    """Phrases and alternatives of the text queries that R07 writes."""
    return lexical.text_matches(table(spark, d, "documents"), spark.createDataFrame(_ASKED, "query_id int, query_text string"), "doc_id", "text")


@query(f"{_TOPK} SELECT query, unit, round(distance, 6) AS distance, rank FROM top WHERE query > 0 AND unit NOT IN (SELECT unit FROM top WHERE query = 0)")
def follow_up_hits(spark, d):
    """What further query vectors find that the first one has not."""
    found = vector.nearest(*_vectors(spark, d))
    fresh = found.where("query > 0").join(found.where("query = 0").select("unit"), "unit", "left_anti")
    return fresh.select("query", "unit", F.round("distance", 6).alias("distance"), "rank")


@query(
    f"""WITH {_NORMAL}, c AS (SELECT *, query_id % 2 = 0 AND position % 3 <> 0 AS removed FROM r WHERE position <= 30),
k AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n, count(*) FILTER (NOT removed) OVER (PARTITION BY query_id) AS kept,
  row_number() OVER (PARTITION BY query_id, removed ORDER BY position) AS place FROM c)
SELECT query_id, content_unit_id, position FROM k WHERE NOT removed OR (n >= 5 AND place <= 5 - kept)"""
)
def rerank_fallback(spark, d):
    """The judge gives no answer for every second query, whose candidates are all kept."""
    hits = table(spark, d, "search_results")
    c = fusion.ranked(fusion.fused(hits), k=30).select("query_id", "content_unit_id", "position")
    judged = F.explode(F.filter(F.sequence(F.lit(1), F.lit(30)), lambda p: p % 3 != 0)).alias("position")
    removed = hits.select("query_id").distinct().where("query_id % 2 = 0").select("query_id", judged)
    return fusion.kept_by_judge(c, removed, 5).drop("restored")


@query(
    """WITH g AS (SELECT document_version_id AS d, iteration AS i, list_sort(list(DISTINCT trim(lower(metric_name), ' ')) FILTER (coalesce(metric_name, '') <> '')) AS q,
  count(*) FILTER (coalesce(metric_value, '') <> '') / count(*)::DOUBLE AS c FROM research_findings GROUP BY 1, 2),
fr AS (SELECT d, i, count(*) AS fresh FROM (SELECT document_version_id AS d, page, min(iteration) AS i FROM research_findings GROUP BY 1, 2) GROUP BY 1, 2),
l AS (SELECT g.d, g.i, coalesce(g.q, []) AS q, c, coalesce(fresh, 0) AS fresh, lag(coalesce(g.q, [])) OVER w AS pq, coalesce(lag(c) OVER w, 0) AS pc FROM g LEFT JOIN fr ON fr.d = g.d AND fr.i = g.i WINDOW w AS (PARTITION BY g.d ORDER BY g.i)),
t AS (SELECT d, i, CASE WHEN len(q) = 0 THEN 'no_additional_queries' WHEN i >= 3 THEN 'max_iterations' WHEN len(pq) > 0 AND list_has_all(pq, q) AND c <= pc THEN 'repeated_follow_up_queries' WHEN fresh = 0 THEN 'follow_up_found_no_new_chunks' END AS reason FROM l)
SELECT d AS document_version_id, i AS iteration, reason AS stop_reason FROM t QUALIFY coalesce(count(reason) OVER (PARTITION BY d ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0"""
)
def research_rounds(spark, d):
    """The rounds of each document's findings until a reason to stop: their metrics as queries, pages not seen before as new chunks."""
    f = table(spark, d, "research_findings")
    named = F.coalesce("metric_name", F.lit("")) != ""
    rounds = f.groupBy("document_version_id", "iteration").agg(
        F.sort_array(F.collect_set(F.when(named, F.trim(F.lower("metric_name"))))).alias("queries"), (F.count_if(F.coalesce("metric_value", F.lit("")) != "") / F.count(F.lit(1))).alias("confidence")
    )
    fresh = f.groupBy("document_version_id", "page").agg(F.min("iteration").alias("iteration")).groupBy("document_version_id", "iteration").agg(F.count(F.lit(1)).alias("new_chunks"))
    return research.loop_rounds(rounds.join(fresh, ["document_version_id", "iteration"], "left"), "document_version_id")


def _written(inventory: DataFrame) -> DataFrame:
    """A deterministic writer: the first lines of the inventory."""
    lines = F.split("inventory", "\n")
    text = F.concat(
        F.lit("intro\n## Summary\n"), F.get(lines, F.lit(0)), F.lit(". Sources agree.\n## Metrics\n| m |\n## Nothing\nx\n## Detail\n"), F.size(lines).cast("string"), F.lit(" places\n## Gaps\n- one\n* two\n\n## Metrics\nlast")
    )
    return inventory.select("document_version_id", text.alias("text"))


_FINAL = """p AS (SELECT document_version_id, page, location_detail, min(finding_id) AS first, arg_min(finding, finding_id) AS finding FROM research_findings GROUP BY 1, 2, 3),
a AS (SELECT document_version_id, arg_min(coalesce(finding, ''), first) AS finding, count(*) AS n FROM p GROUP BY 1),
c AS (SELECT id AS document_version_id, a.finding, a.n, id % 3 <> 0 AS sourced FROM document_versions LEFT JOIN a ON a.document_version_id = id),
fin AS (SELECT document_version_id, n IS NOT NULL AS answered, coalesce(n, 0) AS n_references, CASE WHEN n IS NULL THEN '' ELSE 'last' END AS metrics_table, CASE WHEN n IS NULL THEN '' ELSE n || ' places' END AS detailed_summary,
  CASE WHEN n IS NULL THEN '' ELSE trim('[REF:1] ' || finding || '. Sources agree.', E' \\t\\r\\n') END AS summary_answer,
  CASE WHEN NOT sourced THEN 'No sources returned results.' WHEN n IS NULL THEN 'No findings extracted from sources.' ELSE 'one;two' END AS data_gaps FROM c)"""


def _final(spark, d):
    v = table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"))
    sources = v.where("document_version_id % 3 <> 0")
    return research.final_answers(v, sources, table(spark, d, "research_findings"), _written)


@query(f"WITH {_FINAL} SELECT document_version_id, answered, summary_answer, metrics_table, detailed_summary, data_gaps, n_references FROM fin")
def final_answers(spark, d):
    """Answers of all versions; every third has no sources, and some no findings."""
    out = _final(spark, d).withColumns({"data_gaps": F.array_join("data_gaps", ";"), "answered": F.col("response") != ""})
    return out.select("document_version_id", "answered", "summary_answer", "metrics_table", "detailed_summary", "data_gaps", "n_references")


@query(
    f"""WITH {_FINAL} SELECT document_version_id, sha256(to_json(struct_pack(data_gaps := string_split(data_gaps, ';'), summary_answer := summary_answer, metrics_table := metrics_table))::VARCHAR) AS digest FROM fin"""
)
def public_results(spark, d):
    """what is passed on of each answer, as JSON."""
    out = research.public_json(_final(spark, d), "document_version_id", ("data_gaps", "summary_answer", "metrics_table"))
    return out.select("document_version_id", F.sha2("json", 256).alias("digest"))


@query(
    f"""WITH {_GROUPS}, {_CELLS}, l AS (SELECT entity, metric || CASE WHEN segment <> '' THEN ' [' || segment || ']' ELSE '' END || CASE WHEN unit <> '' THEN ' (' || unit || ')' ELSE '' END || ': ' ||
  string_agg(period || ' ' || display_value || CASE WHEN values_agree THEN '' ELSE ' (differ)' END, '; ' ORDER BY period, display_value) AS line FROM v GROUP BY entity, segment, metric, unit)
SELECT entity, sha256(string_agg(line, chr(10) ORDER BY line)) AS digest FROM l GROUP BY 1"""
)
def metrics_inventory(spark, d):
    """The inventory of each entity as text."""
    cells = findings.period_values(metric_records(spark, d))
    return research.inventory_text(cells, findings.GROUP).select("entity", F.sha2("text", 256).alias("digest"))


@query("SELECT stage_name, sha256(stage_name || chr(0) || coalesce(stage_signature, '') || chr(0) || stage_order) AS signature FROM stage_signatures")
def stage_fingerprints(spark, d):
    """Fingerprints from a stage's configuration and code."""
    s = table(spark, d, "stage_signatures")
    return s.select("stage_name", stages.signature(F.col("stage_name"), F.col("stage_signature"), F.col("stage_order").cast("string")).alias("signature"))


@query(
    """WITH a AS (SELECT artifact_path, CASE WHEN length(artifact_path) % 3 = 0 THEN 'x' ELSE max(artifact_checksum) END AS checksum FROM stage_checkpoints WHERE coalesce(artifact_path, '') <> '' AND length(artifact_path) % 5 <> 0 GROUP BY 1)
SELECT c.document_version_id, c.stage_name, count(*) AS n, count(*) FILTER (coalesce(lower(c.artifact_checksum) = lower(a.checksum), false) AND coalesce(c.artifact_path, '') <> '') AS n_ok
FROM stage_checkpoints c LEFT JOIN a USING (artifact_path) GROUP BY 1, 2"""
)
def verified_artifacts(spark, d):
    """Checkpoints whose artifact is there with their checksum; some artifacts are gone, some were changed."""
    c = table(spark, d, "stage_checkpoints")
    found = c.where("coalesce(artifact_path, '') <> '' AND length(artifact_path) % 5 <> 0").groupBy("artifact_path").agg(F.max("artifact_checksum").alias("checksum"))
    found = found.withColumn("checksum", F.when(F.length("artifact_path") % 3 == 0, "x").otherwise(F.col("checksum")))
    return stages.verified(c, found).groupBy("document_version_id", "stage_name").agg(F.count(F.lit(1)).alias("n"), F.count_if("artifact_ok").alias("n_ok"))


@query(
    """SELECT stage_name, artifact_path FROM (SELECT DISTINCT stage_name, artifact_path FROM stage_checkpoints WHERE coalesce(artifact_path, '') <> '') QUALIFY row_number() OVER (PARTITION BY stage_name ORDER BY artifact_path DESC) <= 5"""
)
def retained_archives(spark, d):
    """Of each stage's artifacts the five last by name."""
    names = table(spark, d, "stage_checkpoints").where("coalesce(artifact_path, '') <> ''").select("stage_name", "artifact_path").distinct()
    return stages.retained(names, ["stage_name"], "artifact_path", 5).where("kept").drop("kept")


@query("SELECT file_path, 1000 + row_number() OVER (ORDER BY file_path) AS id FROM (SELECT DISTINCT file_path FROM document_versions)")
def fresh_ids(spark, d):
    """Ids that go on after those that are taken."""
    return stages.fresh_ids(table(spark, d, "document_versions").select("file_path").distinct(), 1000, ["file_path"])


@query(
    """WITH s AS (SELECT page_result_id, CASE WHEN coalesce(chunk_id, '') = '' THEN 'section' ELSE 'subsection' END AS level, CASE WHEN page_result_id % 2 = 0 THEN 'done' END AS summary FROM page_results)
SELECT page_result_id, CASE WHEN level = 'section' THEN 1 ELSE 2 END AS turn FROM s WHERE level = 'section' OR coalesce(summary, '') = ''"""
)
def sections_to_summarise(spark, d):
    """Primaries first, then subsections without a summary."""
    p = table(spark, d, "page_results")
    level = F.when(F.coalesce("chunk_id", F.lit("")) == "", "section").otherwise("subsection")
    s = p.select("page_result_id", level.alias("level"), F.when(F.col("page_result_id") % 2 == 0, "done").alias("summary"))
    return content.to_summarise(s).select("page_result_id", "turn")


@query("SELECT page_result_id, sha256('Page ' || coalesce(page_number::VARCHAR, '') || ' of version ' || coalesce(document_version_id::VARCHAR, '') || ':' || chr(10) || coalesce(raw_content, '')) AS digest FROM page_results")
def rendered_prompts(spark, d):
    """A prompt filled for each page; pages have braces of their own."""
    text = providers.rendered("Page {page} of version {version}:\n{text}", {"page": F.col("page_number"), "version": F.col("document_version_id"), "text": F.col("raw_content")})
    return table(spark, d, "page_results").select("page_result_id", F.sha2(text, 256).alias("digest"))


@query(
    f"""WITH {_USABLE} SELECT r.document_version_id, CASE WHEN r.completed >= 3 THEN 'chunking' ELSE s.stage_name END AS start_stage FROM run r LEFT JOIN stage_signatures s ON s.stage_order = r.completed + 1"""
)
def forced_plans(spark, d):
    """All versions that have come as far as chunking go on from there."""
    plans = planning.resume_plans(table(spark, d, "document_versions"), table(spark, d, "stage_checkpoints"), table(spark, d, "stage_signatures"))
    return planning.forced(plans, "chunking").select("document_version_id", "start_stage")
