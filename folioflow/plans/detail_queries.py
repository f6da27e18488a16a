"""Queries of the remaining transforms: sections by page, updates, audits, renderings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow import providers
from folioflow.operators import answers, content, findings, planning
from folioflow.plans.answer_queries import _GROUPS, _REFS
from folioflow.plans.answer_queries import _groups as metric_records
from folioflow.plans.search_queries import _units as content_units
from folioflow.schemas import STAGES
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


_UNIT = "coalesce(nullif(chunk_id, ''), page_number::VARCHAR)"
_KEY = "coalesce(try_cast(split_part(chunk_id, '.', 1) AS INT), 0), coalesce(try_cast(nullif(split_part(chunk_id, '.', 2), '') AS INT), 0), page_result_id"
_PAGE_SECTIONS = rf"""t AS (SELECT *, trim(regexp_extract(coalesce(raw_content, ''), '(?m)^#[ \t]+Sheet:[ \t]+([^\r\n]+)', 1), ' ') AS sheet FROM page_results),
ps AS (SELECT document_version_id, page_number, coalesce(arg_min(sheet, ({_KEY})) FILTER (sheet <> ''), 'Page ' || page_number) AS title,
  string_agg({_UNIT}, ',' ORDER BY {_KEY}) AS chunk_ids, sum(coalesce(raw_token_count, 0))::BIGINT AS token_count FROM t GROUP BY 1, 2),
sec AS (SELECT *, (row_number() OVER (PARTITION BY document_version_id ORDER BY page_number))::VARCHAR AS section_id FROM ps)"""


@query(f"WITH {_PAGE_SECTIONS} SELECT document_version_id, section_id, title, page_number AS page_start, chunk_ids, token_count FROM sec")
def page_sections(spark, d):
    """C13, C14"""
    s = content.page_sections(table(spark, d, "page_results"))
    return s.select("document_version_id", "section_id", "title", "page_start", F.array_join("chunk_ids", ",").alias("chunk_ids"), "token_count")


@query(
    f"""WITH {_PAGE_SECTIONS}, c AS (SELECT *, row_number() OVER (PARTITION BY document_version_id, page_number ORDER BY {_KEY}) AS no FROM page_results WHERE chunk_id <> '')
SELECT c.document_version_id, s.section_id || '.' || c.no AS section_id, s.section_id AS parent_section_id, s.title || ' — ' || coalesce(nullif(c.chunk_context, ''), 'Chunk ' || c.no) AS title, c.chunk_id AS unit_id
FROM c JOIN sec s USING (document_version_id, page_number)"""
)
def chunk_subsections(spark, d):
    """C16"""
    p = table(spark, d, "page_results")
    return content.chunk_subsections(p, content.page_sections(p))


@query(
    f"""WITH {_PAGE_SECTIONS} SELECT p.page_result_id, coalesce(nullif(s.title, ''), 'Section ' || p.section_id, '') AS title
FROM page_results p LEFT JOIN sec s ON s.document_version_id = p.document_version_id AND s.section_id = p.section_id"""
)
def section_titles(spark, d):
    """Titles of the units' sections, with a fallback."""
    p = table(spark, d, "page_results")
    s = content.page_sections(p).select("document_version_id", "section_id", "title")
    return p.join(s, ["document_version_id", "section_id"], "left").select(
        "page_result_id", F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("Section "), F.col("section_id")), F.lit("")).alias("title")
    )


_CHILDREN = f"""{_PAGE_SECTIONS}, c AS (SELECT *, row_number() OVER (PARTITION BY document_version_id, page_number ORDER BY {_KEY}) AS no FROM page_results WHERE chunk_id <> ''),
child AS (SELECT c.document_version_id, c.page_number, s.section_id || '.' || c.no AS section_id, s.section_id AS parent, c.chunk_id, c.no FROM c JOIN sec s USING (document_version_id, page_number))"""


@query(
    f"""WITH {_CHILDREN} SELECT p.page_result_id, arg_min(child.section_id, (child.page_number, child.section_id)) AS child_id
FROM page_results p JOIN sec s USING (document_version_id, page_number) JOIN child ON child.document_version_id = s.document_version_id AND child.parent = s.section_id GROUP BY 1"""
)
def first_child_section(spark, d):
    """The first child, by page and id, of the section that a unit's page is."""
    p = table(spark, d, "page_results")
    sections = content.page_sections(p)
    children = content.chunk_subsections(p, sections).join(sections.select("document_version_id", F.col("section_id").alias("parent_section_id"), "page_start"), ["document_version_id", "parent_section_id"])
    first = children.groupBy("document_version_id", "parent_section_id").agg(F.min_by("section_id", F.struct("page_start", "section_id")).alias("child_id"))
    units = p.join(sections.select("document_version_id", F.col("page_start").alias("page_number"), F.col("section_id").alias("parent_section_id")), ["document_version_id", "page_number"])
    return units.join(first, ["document_version_id", "parent_section_id"]).select("page_result_id", "child_id")


@query(
    f"""WITH {_CHILDREN}, x AS (SELECT document_version_id, {_UNIT} AS unit_id, s.section_id, s.section_id::INT AS seq FROM page_results p JOIN sec s USING (document_version_id, page_number)
  UNION ALL SELECT document_version_id, chunk_id, section_id, 1000000 + no FROM child)
SELECT document_version_id, unit_id, arg_max(section_id, (seq, section_id)) AS section_id FROM x GROUP BY 1, 2"""
)
def deepest_section(spark, d):
    """Pages are sections, their chunks subsections that come later in the list."""
    p = table(spark, d, "page_results")
    sections = content.page_sections(p)
    children = content.chunk_subsections(p, sections)
    number = F.element_at(F.split("section_id", r"\."), -1).cast("int")
    listed = sections.select("document_version_id", "section_id", number.alias("sequence"), "chunk_ids").unionByName(
        children.select("document_version_id", "section_id", (number + 1_000_000).alias("sequence"), F.array("unit_id").alias("chunk_ids"))
    )
    return content.deepest_sections(listed)


@query(
    """WITH new AS (SELECT document_version_id, page_number, max(layout_type) AS layout_type FROM documents WHERE document_version_id IS NOT NULL AND page_number IS NOT NULL GROUP BY 1, 2)
SELECT p.page_result_id, coalesce(n.layout_type, p.layout_type) AS layout_type FROM page_results p LEFT JOIN new n USING (document_version_id, page_number)"""
)
def updated_layouts(spark, d):
    """Layouts that the documents table knows better."""
    new = table(spark, d, "documents").where("document_version_id IS NOT NULL AND page_number IS NOT NULL").groupBy("document_version_id", "page_number").agg(F.max("layout_type").alias("layout_type"))
    return content.updated(table(spark, d, "page_results"), new, ["document_version_id", "page_number"], ["layout_type"]).select("page_result_id", "layout_type")


@query(
    """WITH f AS (SELECT query_id, content_unit_id, min(sub_query::VARCHAR) AS o FROM search_results WHERE strategy = 'subquery_vector' GROUP BY 1, 2),
i AS (SELECT query_id, content_unit_id, min(strategy) AS o FROM search_results WHERE strategy <> 'subquery_vector' GROUP BY 1, 2)
SELECT query_id, content_unit_id, coalesce(f.o, i.o, '') AS origin FROM (SELECT DISTINCT query_id, content_unit_id FROM search_results) LEFT JOIN f USING (query_id, content_unit_id) LEFT JOIN i USING (query_id, content_unit_id)"""
)
def chunk_lineage(spark, d):
    """J15"""
    s, key = table(spark, d, "search_results"), ["query_id", "content_unit_id"]
    follow = s.where("strategy = 'subquery_vector'").select(*key, F.col("sub_query").cast("string").alias("origin"))
    return answers.lineage(s.select(*key).distinct(), follow, s.where("strategy <> 'subquery_vector'").select(*key, F.col("strategy").alias("origin")), key)


@query(
    """SELECT query_id, strategy, coalesce(sub_query, 0) AS sub_query, content_unit_id, min(coalesce(-score, distance)) AS cost,
  row_number() OVER (PARTITION BY query_id, strategy, coalesce(sub_query, 0) ORDER BY min(coalesce(-score, distance)) NULLS LAST, content_unit_id) AS rank
FROM search_results GROUP BY 1, 2, 3, 4"""
)
def hit_ranks(spark, d):
    """W05"""
    s = table(spark, d, "search_results").groupBy("query_id", "strategy", F.coalesce("sub_query", F.lit(0)).alias("sub_query"), "content_unit_id").agg(F.min(F.coalesce(-F.col("score"), F.col("distance"))).alias("cost"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "strategy", "sub_query").orderBy(F.col("cost").asc_nulls_last(), "content_unit_id")))


@query(
    f"""SELECT document_version_id, {_UNIT} AS content_unit_id, row_number() OVER (PARTITION BY document_version_id ORDER BY page_number NULLS FIRST, {_UNIT}, page_result_id) AS position FROM page_results"""
)
def page_text_order(spark, d):
    """O05"""
    w = Window.partitionBy("document_version_id").orderBy("page_number", "content_unit_id", "page_result_id")
    return content_units(spark, d).select("document_version_id", "content_unit_id", F.row_number().over(w).alias("position"))


@query(
    """WITH a AS (SELECT id AS document_version_id, s.stage_name FROM document_versions, stage_signatures s WHERE is_current),
b AS (SELECT DISTINCT c.document_version_id, stage_name FROM stage_checkpoints c JOIN document_versions v ON v.id = c.document_version_id WHERE v.is_current)
SELECT *, 'missing' AS problem FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'unexpected' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""
)
def set_differences(spark, d):
    """Stages that a current version should have and has not, or has and should not."""
    v = table(spark, d, "document_versions").where("is_current").select(F.col("id").alias("document_version_id"))
    expected = v.select("document_version_id", F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage_name"))
    actual = table(spark, d, "stage_checkpoints").join(v, "document_version_id", "left_semi").select("document_version_id", "stage_name").distinct()
    return content.set_differences(expected, actual)


@query(
    """SELECT page_result_id, len(coalesce(keywords, [])) > 0 AND len(coalesce(entities, [])) > 0 AND len(list_filter(entities, lambda e: NOT list_contains(list_transform(keywords, lambda k: lower(trim(k, ' '))), lower(trim(e, ' '))))) = 0 AS is_repeat FROM page_results"""
)
def repeated_queries(spark, d):
    """Whether a page's entities, asked after its keywords, would only repeat them."""
    none = F.array().cast("array<string>")
    return table(spark, d, "page_results").select("page_result_id", answers.is_repeat(F.coalesce("keywords", none), F.coalesce("entities", none)).alias("is_repeat"))


@query(
    r"""WITH l AS (SELECT page_result_id, regexp_split_to_array(coalesce(raw_content, ''), '\r\n|\r|\n') AS lines FROM page_results),
x AS (SELECT page_result_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM l)
SELECT page_result_id, string_agg(DISTINCT no::VARCHAR, ',' ORDER BY no::VARCHAR) AS breakpoints FROM x WHERE line LIKE '#%' OR (no > 1 AND no % 100 = 1) GROUP BY 1"""
)
def merged_breakpoints(spark, d):
    """Breakpoints at headings and at every batch of 100 lines, once each."""
    lines = F.split(F.coalesce("raw_content", F.lit("")), r"\r\n|\r|\n")
    numbered = F.filter(F.transform(lines, lambda x, i: F.when((i > 0) & (i % 100 == 0), i + 1)), lambda x: x.isNotNull())
    both = F.array_sort(F.array_distinct(F.transform(F.concat(content.heading_breaks(lines), numbered), lambda x: x.cast("string"))))
    return table(spark, d, "page_results").select("page_result_id", F.array_join(both, ",").alias("breakpoints")).where("breakpoints <> ''")


@query(
    """WITH p AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS part, max(l_quantity::INT) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, string_agg(part || ': ' || q, '; ' ORDER BY l_linenumber) AS series FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) <= 12) GROUP BY 1"""
)
def chart_series(spark, d):
    """Orders as chart series."""
    p = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("part"), F.max(F.col("l_quantity").cast("int")).alias("q"))
    points = p.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "part", "q"))).alias("x"))
    return points.select("l_orderkey", content.series_text(F.col("x.part"), F.col("x.q")).alias("series"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_discount >= 0 AND l_discount < l_tax AND l_tax <= 1 AND l_quantity / 50 < 1.0 AND l_quantity / 50 >= 0 AS valid FROM lineitem")
def valid_boxes(spark, d):
    """Corner checks on (discount, quantity / 50) to (tax, 1)."""
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", content.valid_box(F.col("l_discount"), F.col("l_quantity") / 50, F.col("l_tax"), F.lit(1.0)).alias("valid"))


@query("SELECT id, level, level = 'section' OR (level = 'subsection' AND summary <> '') AS embeddable FROM (SELECT page_result_id AS id, CASE WHEN contains(section_id, '.') THEN 'subsection' WHEN section_id <> '' THEN 'section' ELSE '' END AS level, coalesce(chunk_context, '') AS summary FROM page_results)")
def embeddable_sections(spark, d):
    """F04, F05"""
    level = F.when(F.contains("section_id", F.lit(".")), "subsection").when(F.col("section_id") != "", "section").otherwise("")
    return table(spark, d, "page_results").select(F.col("page_result_id").alias("id"), level.alias("level"), content.is_embeddable(level, F.col("chunk_context")).alias("embeddable"))


@query("SELECT query_id, strategy, content_unit_id, coalesce(page_number, 0) AS page, round(score, 6) AS score, round(distance, 6) AS distance FROM search_results")
def hit_snapshots(spark, d):
    """F11, F12"""
    return table(spark, d, "search_results").select("query_id", "strategy", "content_unit_id", F.coalesce("page_number", F.lit(0)).alias("page"), F.round("score", 6).alias("score"), F.round("distance", 6).alias("distance"))


@query(
    """SELECT stage_name, count(*) AS attempts, sum(epoch_us(completed_at) - epoch_us(started_at))::BIGINT AS total_us, max(epoch_us(completed_at) - epoch_us(started_at)) AS longest_us,
  greatest(sum(epoch_us(completed_at) - epoch_us(started_at)) - (max(epoch_us(completed_at)) - min(epoch_us(started_at))), 0)::BIGINT AS overlap_us, arg_max(lower(trim(status)), (updated_at, document_version_id, lower(trim(status)))) AS last_status
FROM stage_checkpoints WHERE completed_at IS NOT NULL AND started_at IS NOT NULL GROUP BY 1"""
)
def stage_metrics(spark, d):
    """Time in each stage, its longest run, the time that runs overlapped, the last status."""
    c = table(spark, d, "stage_checkpoints").where("completed_at IS NOT NULL AND started_at IS NOT NULL")
    took = F.unix_micros("completed_at") - F.unix_micros("started_at")
    status = F.lower(F.trim("status"))
    return c.groupBy("stage_name").agg(
        F.count(F.lit(1)).alias("attempts"), F.sum(took).alias("total_us"), F.max(took).alias("longest_us"),
        F.greatest(F.sum(took) - (F.max(F.unix_micros("completed_at")) - F.min(F.unix_micros("started_at"))), F.lit(0)).alias("overlap_us"),
        F.max_by(status, F.struct("updated_at", "document_version_id", status)).alias("last_status"),
    )


@query("SELECT finding_id, trim(coalesce(unit, ''), ' ') AS unit FROM research_findings")
def canonical_unit(spark, d):
    """M05"""
    return table(spark, d, "research_findings").select("finding_id", F.trim(findings.text_or_blank(F.col("unit"))).alias("unit"))


@query(
    """SELECT document_version_id, count(*) AS n_findings, count(*) FILTER (coalesce(finding, '') <> '' AND coalesce(page, 0) > 0 AND coalesce(location_detail, '') <> ''
  AND coalesce(trim(metric_name, ' ') <> '', true) AND coalesce(trim(metric_value, ' ') <> '', true) AND coalesce(trim(unit, ' ') <> '', true) AND coalesce(trim(period, ' ') <> '', true) AND coalesce(trim(segment, ' ') <> '', true)) AS n_valid
FROM research_findings GROUP BY 1"""
)
def valid_findings(spark, d):
    """Findings written as a model's JSON, read again and validated."""
    f = table(spark, d, "research_findings")
    item = F.struct("finding", "page", "location_detail", "metric_name", "metric_value", "unit", "period", "segment")
    payload = f.groupBy("document_version_id").agg(F.to_json(F.struct(F.collect_list(item).alias("findings"), F.lit(1.0).alias("confidence"))).alias("p"))
    parsed = payload.select("document_version_id", findings.parsed_findings(F.col("p")).alias("f"))
    return parsed.select("document_version_id", F.size("f").cast("bigint").alias("n_findings"), F.size(F.filter("f", findings.is_valid_finding)).cast("bigint").alias("n_valid"))


@query(
    f"""WITH {_GROUPS}, {_REFS}, r AS (SELECT f.finding_id, v.data_source AS source, refs.ref_id FROM research_findings f JOIN refs USING (document_version_id, page, location_detail) JOIN document_versions v ON v.id = f.document_version_id),
o AS (SELECT entity, segment, metric, unit, period, metric_value, CASE WHEN ref_id IS NOT NULL THEN coalesce(source, '') || ' [REF:' || ref_id || ']' ELSE coalesce(source, '') END AS label, min(g.finding_id) AS first
  FROM g LEFT JOIN r ON r.finding_id = g.finding_id GROUP BY ALL)
SELECT entity, segment, metric, unit, period, metric_value, string_agg(label, '; ' ORDER BY first) AS sources FROM o GROUP BY ALL"""
)
def value_sources(spark, d):
    """M09"""
    f = table(spark, d, "research_findings")
    v = table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"), F.col("data_source").alias("source"))
    refs = f.select("finding_id", "document_version_id", "page", "location_detail").join(findings.references(f), ["document_version_id", "page", "location_detail"]).join(v, "document_version_id")
    return findings.source_refs(metric_records(spark, d), refs)


@query(
    f"""WITH {_REFS} SELECT document_version_id, '## References' || chr(10) || '| # | Source | File | Page | Location |' || chr(10) || '|---|--------|------|------|----------|' || chr(10) ||
  string_agg('| ' || ref_id || ' | ' || coalesce(v.data_source, '') || ' | ' || coalesce(v.filename, '') || ' | ' || coalesce(page, 0) || ' | ' || coalesce(location_detail, '') || ' |', chr(10) ORDER BY ref_id) AS appendix
FROM refs JOIN document_versions v ON v.id = document_version_id GROUP BY 1"""
)
def reference_appendix(spark, d):
    """M14"""
    v = table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"), F.col("data_source").alias("source"), "filename")
    return answers.reference_appendix(findings.references(table(spark, d, "research_findings")).join(v, "document_version_id"))


@query("SELECT document_version_id, coalesce(section_id, '') AS section_id, min(page_number) AS first_page, max(page_number) AS last_page, count(*) AS units FROM page_results GROUP BY 1, 2")
def context_sections(spark, d):
    """M16"""
    return answers.context_sections(table(spark, d, "page_results"))


@query("SELECT stage_name, stage_order::INT AS position, stage_order >= 4 AND stage_order <= 9 AS in_range, stage_order > 4 AS downstream FROM stage_signatures")
def stage_ranges(spark, d):
    """The range from chunking to doc_summary, and what comes after chunking."""
    chosen, after = planning.stage_range("chunking", "doc_summary"), planning.stage_range("chunking")[1:]
    s = table(spark, d, "stage_signatures")
    position = F.array_position(F.array(*[F.lit(x) for x in STAGES]), F.col("stage_name")).cast("int")
    return s.select("stage_name", position.alias("position"), F.col("stage_name").isin(*chosen).alias("in_range"), F.col("stage_name").isin(*after).alias("downstream"))


@query("SELECT p.page_result_id, sha256(coalesce(p.raw_content, '')) AS digest, c.copies FROM page_results p JOIN (SELECT coalesce(raw_content, '') AS t, count(*) AS copies FROM page_results GROUP BY 1) c ON c.t = coalesce(p.raw_content, '')")
def distinct_calls(spark, d):
    """One call for each distinct content; the call counts its copies by digest."""
    p = table(spark, d, "page_results")
    counts = p.groupBy(F.sha2(F.coalesce("raw_content", F.lit("")), 256).alias("_digest")).agg(F.count(F.lit(1)).alias("copies"))
    out = content.distinct_calls(p, "raw_content", lambda once: once.select("_digest").join(counts, "_digest"))
    return out.select("page_result_id", F.sha2(F.coalesce("raw_content", F.lit("")), 256).alias("digest"), "copies")


@query(
    r"""WITH w AS (SELECT page_result_id, md5(unnest(regexp_extract_all(lower(raw_content), '[\pL\pN_]+'))) AS h FROM page_results WHERE raw_content IS NOT NULL),
c AS (SELECT page_result_id, ('0x' || substr(h, 15, 2))::INT % 64 AS i, sum(CASE WHEN substr(h, 1, 1) >= '8' THEN 1 ELSE -1 END) AS v FROM w GROUP BY 1, 2),
n AS (SELECT page_result_id, sqrt(sum(v * v)) AS length FROM c GROUP BY 1), d AS (SELECT unnest(range(0, 64)) AS i)
SELECT n.page_result_id, sha256(string_agg(coalesce(round(1000 * v / length), 0)::INT::VARCHAR, ',' ORDER BY d.i)) AS digest
FROM n CROSS JOIN d LEFT JOIN c ON c.page_result_id = n.page_result_id AND c.i = d.i WHERE length > 0 GROUP BY n.page_result_id"""
)
def embed_hash(spark, d):
    """Offline embeddings of all pages that have words, as digests of their thousandths."""
    e = providers.embedded(table(spark, d, "page_results").select("page_result_id", "raw_content"), "raw_content").where(F.col("vector").isNotNull())
    return e.select("page_result_id", F.sha2(F.array_join(F.transform("vector", lambda x: F.round(x * 1000).cast("int").cast("string")), ","), 256).alias("digest"))


@query(
    r"""WITH w AS (SELECT item_id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9]{3,}')) AS word FROM eval_items),
c AS (SELECT item_id, word, count(*) AS n FROM w GROUP BY 1, 2), k AS (SELECT item_id, word, n FROM c QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n DESC, word) <= 5),
kk AS (SELECT item_id, string_agg(word, ';' ORDER BY n DESC, word) AS keywords FROM k GROUP BY 1),
e AS (SELECT item_id, unnest(l) AS name, generate_subscripts(l, 1) AS i FROM (SELECT item_id, regexp_extract_all(text, '\b[A-Z][a-z]+(?: [A-Z][a-z]+)+\b') AS l FROM eval_items)),
ee AS (SELECT item_id, name, min(i) AS i FROM e GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY min(i)) <= 4),
en AS (SELECT item_id, string_agg(name, ';' ORDER BY i) AS entities FROM ee GROUP BY 1)
SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g'), ' ') AS rewritten_query, coalesce(keywords, '') AS keywords, coalesce(entities, '') AS entities FROM eval_items LEFT JOIN kk USING (item_id) LEFT JOIN en USING (item_id)"""
)
def query_preparation(spark, d):
    """Questions prepared by the offline provider: frequent words, capitalised names."""
    q = table(spark, d, "eval_items").select("item_id", "text")
    a = providers.answers(q, "text", "query_prep")
    return a.select("item_id", "answer.rewritten_query", F.array_join(answers.limited_texts(F.col("answer.keywords"), 8), ";").alias("keywords"), F.array_join(answers.limited_texts(F.col("answer.entities"), 4), ";").alias("entities"))
