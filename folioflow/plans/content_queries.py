"""Queries of the page, chunk and section operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import content
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


_LINES = r"list_filter(list_transform(regexp_split_to_array(coalesce(raw_content, ''), '\r\n|\r|\n'), lambda x: trim(x, E' \t\r\n\f\v')), lambda x: x <> '')"
_TABLE = "len(list_filter(l, lambda x: x[1] = '|' AND x[-1] = '|' AND length(x) >= 2))"
_BULLET = "len(list_filter(l, lambda x: starts_with(x, '- ') OR starts_with(x, '* ') OR starts_with(x, '• ') OR starts_with(x, '1. ') OR starts_with(x, '2. ') OR starts_with(x, '3. ')))"
_TIER = "CASE WHEN n <= 5000 THEN 'low' WHEN n <= 10000 THEN 'medium' ELSE 'high' END"
_PAGES = f"""p AS (SELECT *, {_LINES} AS l, len(regexp_extract_all(coalesce(raw_content, ''), '[^ \\t\\r\\n]+')) AS n, lower(coalesce(raw_content, '')) AS low FROM page_results)"""


def _pages(spark, d):
    p = table(spark, d, "page_results")
    return p.withColumn("n", content.word_count(F.col("raw_content")))


@query(f"WITH {_PAGES} SELECT page_result_id, n::INT AS n_tokens, {_TIER} AS tier FROM p")
def token_tier(spark, d):
    """Recounted tokens and tiers, whatever the table records."""
    return _pages(spark, d).select("page_result_id", F.col("n").alias("n_tokens"), content.token_tier(F.col("n")).alias("tier"))


@query(f"WITH {_PAGES} SELECT page_result_id, len(l)::INT AS n_lines, {_TABLE}::INT AS n_table, {_BULLET}::INT AS n_bullet FROM p")
def line_counts(spark, d):
    """C04"""
    lines = content.lines_of(F.col("raw_content"))
    return table(spark, d, "page_results").select("page_result_id", F.size(lines).alias("n_lines"), content.table_lines(lines).alias("n_table"), content.bullet_lines(lines).alias("n_bullet"))


_LAYOUT = f"""CASE WHEN v.filetype = 'xlsx' THEN 'spreadsheet' WHEN v.filetype = 'pptx' THEN 'presentation_slide' WHEN len(l) = 0 THEN 'empty'
  WHEN {_TABLE} >= 4 THEN CASE WHEN {_TIER} = 'high' THEN 'dense_table' ELSE 'table' END
  WHEN contains(low, '![') OR contains(low, 'chart') OR contains(low, 'diagram') OR contains(low, 'figure') OR contains(low, 'image') OR contains(low, 'photo') OR contains(low, 'screenshot') OR {_BULLET} >= 4 THEN 'visual_heavy'
  WHEN {_TIER} = 'high' THEN 'longform_text' ELSE 'narrative_text' END"""


def _layouts(spark, d):
    v = table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"), "filetype")
    return _pages(spark, d).join(v, "document_version_id", "left").withColumn("layout", content.layout_type(F.col("filetype"), F.col("raw_content"), content.token_tier(F.col("n"))))


@query(f"WITH {_PAGES} SELECT page_result_id, {_LAYOUT} AS layout FROM p LEFT JOIN document_versions v ON v.id = p.document_version_id")
def layout_type(spark, d):
    """C03"""
    return _layouts(spark, d).select("page_result_id", "layout")


@query(f"WITH {_PAGES}, y AS (SELECT p.document_version_id, {_LAYOUT} AS layout FROM p LEFT JOIN document_versions v ON v.id = p.document_version_id) SELECT document_version_id, layout, count(*) AS pages FROM y GROUP BY ALL")
def layout_summary(spark, d):
    """A05"""
    return _layouts(spark, d).groupBy("document_version_id", "layout").agg(F.count(F.lit(1)).alias("pages"))


@query(
    f"WITH {_PAGES} SELECT document_version_id, sum(n)::BIGINT AS tokens, count(*) FILTER (n <= 5000) AS low, count(*) FILTER (n > 5000 AND n <= 10000) AS medium, count(*) FILTER (n > 10000) AS high FROM p GROUP BY 1"
)
def tier_counts(spark, d):
    """A06"""
    return _pages(spark, d).groupBy("document_version_id").agg(
        F.sum("n").alias("tokens"), F.count_if(F.col("n") <= 5000).alias("low"), F.count_if((F.col("n") > 5000) & (F.col("n") <= 10000)).alias("medium"), F.count_if(F.col("n") > 10000).alias("high")
    )


@query(f"WITH {_PAGES} SELECT page_result_id, n::INT AS n_tokens, CASE WHEN n > 80000 THEN 'truncate' ELSE 'split' END AS route FROM p WHERE n > 8192")
def oversized_chunks(spark, d):
    """F06, C05"""
    return _pages(spark, d).where(F.col("n") > content.EMBEDDING_LIMIT).select(
        "page_result_id", F.col("n").alias("n_tokens"), F.when(F.col("n") > content.TRUNCATION_LIMIT, "truncate").otherwise("split").alias("route")
    )


@query(
    r"""WITH t AS (SELECT page_result_id, raw_content, regexp_extract_all(coalesce(raw_content, ''), '[^ \t\r\n]+') AS w FROM page_results)
SELECT page_result_id, sha256(CASE WHEN len(w) > 1000 THEN array_to_string(w[1:1000], ' ') ELSE raw_content END) AS digest FROM t WHERE raw_content IS NOT NULL"""
)
def truncated_content(spark, d):
    """C07, to 1,000 tokens."""
    p = table(spark, d, "page_results").where("raw_content IS NOT NULL")
    return p.select("page_result_id", F.sha2(content.truncated(F.col("raw_content"), 1000), 256).alias("digest"))


@query(
    r"""SELECT page_result_id, len(regexp_extract_all(coalesce(raw_content, ''), '[^ \t\r\n]+'))::INT AS raw_tokens,
  len(regexp_extract_all(concat_ws(chr(10), nullif(chunk_header, ''), nullif(raw_content, '')), '[^ \t\r\n]+'))::INT AS embedding_tokens FROM page_results"""
)
def recounted_tokens(spark, d):
    """C08"""
    text = content.embedding_text([F.col("chunk_header"), F.col("raw_content")])
    return table(spark, d, "page_results").select("page_result_id", content.word_count(F.col("raw_content")).alias("raw_tokens"), content.word_count(text).alias("embedding_tokens"))


@query(
    r"""WITH l AS (SELECT page_result_id, regexp_split_to_array(coalesce(raw_content, ''), '\r\n|\r|\n') AS lines FROM page_results),
x AS (SELECT page_result_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM l),
s AS (SELECT *, sum(CASE WHEN no = 1 OR line LIKE '#%' THEN 1 ELSE 0 END) OVER (PARTITION BY page_result_id ORDER BY no) AS chunk_no FROM x)
SELECT page_result_id, chunk_no::INT AS chunk_no, 'Lines ' || min(no) || '-' || max(no) AS chunk_context, sha256(string_agg(line, chr(10) ORDER BY no)) AS digest FROM s GROUP BY 1, 2"""
)
def split_chunks(spark, d):
    """Pages split at their headings."""
    return content.markdown_chunks(table(spark, d, "page_results"), ["page_result_id"], "raw_content").select("page_result_id", "chunk_no", "chunk_context", F.sha2("chunk_text", 256).alias("digest"))


_SHEETS = r"""l AS (SELECT page_result_id, regexp_split_to_array(coalesce(raw_content, ''), '\r\n|\n') AS lines FROM page_results),
x AS (SELECT page_result_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM l),
q AS (SELECT page_result_id, coalesce(min(no) FILTER (line LIKE '>%'), 1000000000) AS quote FROM x GROUP BY 1),
r AS (SELECT x.page_result_id, regexp_extract(line, '^\|\s*(\d+)\s*\|', 1)::INT AS row_no, line, row_number() OVER (PARTITION BY x.page_result_id ORDER BY no) AS i
  FROM x JOIN q USING (page_result_id) WHERE no < quote AND regexp_matches(line, '^\|\s*\d+\s*\|'))"""


@query(f"WITH {_SHEETS} SELECT page_result_id, count(*)::INT AS n_rows, min(row_no) AS first_row, max(row_no) AS last_row FROM r GROUP BY 1")
def sheet_rows(spark, d):
    """C10"""
    p = table(spark, d, "page_results").select("page_result_id", content.sheet_parts(F.col("raw_content")).alias("s")).where(F.size("s.rows") > 0)
    return p.select("page_result_id", F.size("s.rows").alias("n_rows"), F.array_min("s.rows.row_no").alias("first_row"), F.array_max("s.rows.row_no").alias("last_row"))


@query(
    f"""WITH {_SHEETS}, c AS (SELECT *, (i - 1) // 50 + 1 AS chunk_no FROM r)
SELECT page_result_id, chunk_no::INT AS chunk_no, 'Rows ' || arg_min(row_no, i) || '-' || arg_max(row_no, i) AS chunk_context, count(*)::INT AS n_rows FROM c GROUP BY 1, 2"""
)
def row_segments(spark, d):
    """W08, C11"""
    return content.sheet_chunks(table(spark, d, "page_results"), ["page_result_id"], "raw_content").select("page_result_id", "chunk_no", "chunk_context", "n_rows")


@query(
    """WITH RECURSIVE o AS (SELECT document_version_id AS doc, page_number, page_result_id, coalesce(raw_token_count, 0)::BIGINT AS tokens,
  row_number() OVER (PARTITION BY document_version_id ORDER BY page_number NULLS FIRST, page_result_id) AS i FROM page_results),
b AS (SELECT doc, i, page_result_id, tokens, 1 AS batch, tokens AS total FROM o WHERE i = 1
  UNION ALL SELECT o.doc, o.i, o.page_result_id, o.tokens, CASE WHEN b.total + o.tokens > 3000 THEN b.batch + 1 ELSE b.batch END, CASE WHEN b.total + o.tokens > 3000 THEN o.tokens ELSE b.total + o.tokens END
  FROM b JOIN o ON o.doc = b.doc AND o.i = b.i + 1)
SELECT doc AS document_version_id, page_result_id, batch FROM b"""
)
def greedy_batches(spark, d):
    """W06"""
    return content.greedy_batches(table(spark, d, "page_results"), "document_version_id", ["page_number", "page_result_id"], "raw_token_count", 3000).select("document_version_id", "page_result_id", "batch")


@query(
    """SELECT document_version_id, page_result_id FROM page_results
WINDOW w AS (PARTITION BY document_version_id ORDER BY page_number NULLS FIRST, page_result_id ROWS UNBOUNDED PRECEDING)
QUALIFY sum(coalesce(raw_token_count, 0)) OVER w <= 3000 OR row_number() OVER w = 1"""
)
def budget_prefix(spark, d):
    """W07"""
    return content.budget_prefix(table(spark, d, "page_results"), "document_version_id", [F.col("page_number"), F.col("page_result_id")], "raw_token_count", 3000).select("document_version_id", "page_result_id")


@query(
    r"""SELECT page_result_id, trim(CASE WHEN regexp_matches(coalesce(raw_content, ''), '(?m)^#[ \t]+Sheet:[ \t]+.+$') THEN regexp_extract(raw_content, '(?m)^#[ \t]+Sheet:[ \t]+([^\r\n]+)', 1)
  ELSE regexp_extract(coalesce(raw_content, ''), '(?m)^#+[ \t]+([^\r\n]+)', 1) END, ' ') AS unit_name FROM page_results"""
)
def unit_names(spark, d):
    """C17"""
    return table(spark, d, "page_results").select("page_result_id", content.unit_name(F.coalesce("raw_content", F.lit(""))).alias("unit_name"))


@query(
    """SELECT document_version_id, page_number, page_result_id FROM page_results
QUALIFY row_number() OVER (PARTITION BY document_version_id, page_number ORDER BY coalesce(chunk_id, '') <> '', coalesce(chunk_id, ''), page_result_id) = 1"""
)
def one_row_per_page(spark, d):
    """A22"""
    return content.one_row_per_page(table(spark, d, "page_results")).select("document_version_id", "page_number", "page_result_id")


_STARTS = r"""one AS (SELECT * FROM page_results QUALIFY row_number() OVER (PARTITION BY document_version_id, page_number ORDER BY coalesce(chunk_id, '') <> '', coalesce(chunk_id, ''), page_result_id) = 1),
t AS (SELECT document_version_id, page_number, trim(regexp_extract(coalesce(raw_content, ''), '^\s*#+[ \t]+([^\r\n]+)', 1), ' ') AS title,
  min(page_number) OVER (PARTITION BY document_version_id) AS first_page, max(page_number) OVER (PARTITION BY document_version_id) AS last_page FROM one),
sec AS (SELECT document_version_id, row_number() OVER w AS no, CASE WHEN title <> '' THEN title ELSE 'Page ' || page_number END AS title, page_number AS page_start,
  coalesce(lead(page_number) OVER w - 1, last_page) AS page_end FROM t WHERE title <> '' OR page_number = first_page
  WINDOW w AS (PARTITION BY document_version_id ORDER BY page_number, CASE WHEN title <> '' THEN title ELSE 'Page ' || page_number END))"""


@query(f"WITH {_STARTS} SELECT document_version_id, no::VARCHAR AS section_id, title, page_start, page_end FROM sec")
def section_ranges(spark, d):
    """J08, W03, C15 with the offline provider"""
    return content.section_ranges(content.section_starts(table(spark, d, "page_results")))


@query(
    f"""WITH {_STARTS}, j AS (SELECT s.document_version_id, s.no, s.page_start, s.page_end, sum(coalesce(p.raw_token_count, 0)) AS tokens, count(p.page_result_id) AS units
  FROM sec s LEFT JOIN page_results p ON p.document_version_id = s.document_version_id AND p.page_number BETWEEN s.page_start AND s.page_end GROUP BY ALL)
SELECT document_version_id, no::VARCHAR AS section_id, tokens::BIGINT AS tokens, units FROM j WHERE NOT (tokens = 0 AND page_start > page_end)"""
)
def section_tokens(spark, d):
    """Units and tokens of each section, without empty inverted ones."""
    p = table(spark, d, "page_results")
    sections = content.section_ranges(content.section_starts(p))
    owned = content.pages_in_sections(p, sections).groupBy("document_version_id", "section_id").agg(F.sum(F.coalesce("raw_token_count", F.lit(0))).alias("tokens"), F.count(F.lit(1)).alias("units"))
    joined = sections.join(owned, ["document_version_id", "section_id"], "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "units": F.coalesce("units", F.lit(0))})
    return joined.where(~((F.col("tokens") == 0) & (F.col("page_start") > F.col("page_end")))).select("document_version_id", "section_id", "tokens", "units")


@query(
    f"""WITH {_STARTS} SELECT document_version_id, no::VARCHAR AS section_id, coalesce(string_agg(no::VARCHAR || ' | ' || left(title, 80) || ' | p.' || page_start, '; ') OVER
  (PARTITION BY document_version_id ORDER BY page_start, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS toc FROM sec"""
)
def progressive_toc(spark, d):
    """W10, C19"""
    sections = content.section_ranges(content.section_starts(table(spark, d, "page_results")))
    return content.progressive_toc(sections).select("document_version_id", "section_id", "toc")


@query(
    f"""WITH {_STARTS} SELECT p.page_result_id, sha256(CASE WHEN s.title <> '' THEN 'Section: ' || s.title || '. ' ELSE '' END || p.raw_content) AS digest
FROM page_results p JOIN sec s ON s.document_version_id = p.document_version_id AND p.page_number BETWEEN s.page_start AND s.page_end WHERE p.raw_content <> ''"""
)
def embedding_texts(spark, d):
    """Text to embed of each unit with its section's title; blank ones are left out."""
    p = table(spark, d, "page_results")
    owned = content.pages_in_sections(p, content.section_ranges(content.section_starts(p))).where("raw_content <> ''")
    text = F.concat(F.when(F.col("section_title") != "", F.concat(F.lit("Section: "), F.col("section_title"), F.lit(". "))).otherwise(""), F.col("raw_content"))
    return owned.select("page_result_id", F.sha2(text, 256).alias("digest"))


@query(
    r"""WITH c AS (SELECT l_orderkey, l_linenumber, l_suppkey % 4 + 1 AS col, max(l_quantity::INT)::VARCHAR AS v FROM lineitem  GROUP BY ALL),
k AS (SELECT l_orderkey, list_sort(list(DISTINCT col)) AS cols FROM c GROUP BY 1),
r AS (SELECT l_orderkey, l_linenumber, cols, '| ' || l_linenumber || ' | ' || array_to_string(list_transform(cols, lambda x: coalesce(m[x], '')), ' | ') || ' |' AS line
  FROM (SELECT l_orderkey, l_linenumber, map_from_entries(list((col, v))) AS m FROM c GROUP BY 1, 2) JOIN k USING (l_orderkey))
SELECT l_orderkey, '| Row | ' || array_to_string(list_transform(any_value(cols), lambda x: chr((64 + x)::INT)), ' | ') || ' |' || chr(10) || '| ' || array_to_string(list_transform(range(0, (len(any_value(cols)) + 1)::BIGINT), lambda x: '---'), ' | ') || ' |'
  || chr(10) || string_agg(line, chr(10) ORDER BY l_linenumber) AS markdown FROM r GROUP BY 1"""
)
def sheet_markdown(spark, d):
    """Orders as sheets, their lines as rows."""
    c = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 4 + 1).cast("int").alias("col")).agg(F.max(F.col("l_quantity").cast("int")).cast("string").alias("v"))
    return content.sheet_markdown(c, ["l_orderkey"], "l_linenumber", "col", "v")
