"""Queries of the findings and answer operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import answers, findings
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


def _period(c: str) -> str:
    """SQL of a canonical period."""
    t = rf"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'), ' ')"
    year = "CASE WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END"
    q2 = rf"regexp_extract({t}, '(?i)\bq([1-4])\s*[/\s]?\s*(\d{{2,4}})\b', 2)"
    q1 = rf"regexp_extract({t}, '(?i)\bq([1-4])\s*[/\s]?\s*(\d{{2,4}})\b', 1)"
    fy = rf"regexp_extract({t}, '(?i)\bfy\s*[/\s]?\s*(\d{{2,4}})\b', 1)"
    return rf"""CASE WHEN regexp_matches({t}, '(?i)\b(?:change|qoq|yoy|vs\.?|versus|delta|growth)\b') THEN {t}
  WHEN {q1} <> '' THEN 'Q' || {q1} || ' ' || {year.format(y=q2)} WHEN {fy} <> '' THEN 'FY ' || {year.format(y=fy)} ELSE {t} END"""


_METRIC = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(coalesce(metric_name, ''), ' '),
  '(?i)(?:\s*[—–-]\s*(?:prior\s+(?:quarter|year|period)|q[1-4]\s*[/\s]\s*\d{2,4}|fy\s*\d{2,4}|(?:yoy|qoq)(?:\s+change)?)\s*)+$', ''),
  '(?i)\s*\((?:\$mm|\$b|%|bps|x|#|millions?|billions?)\)\s*$', ''),
  '(?:[A-Z][a-zA-Z0-9]*\s+)(?:(?:[A-Za-z][a-zA-Z0-9]*|\d+)\s+)*\(([A-Z][A-Z0-9]+)\)', '\1', 'g'), '\s+', ' ', 'g'), ' '))"""


@query(f"SELECT finding_id, {_period('period')} AS period FROM research_findings")
def canonical_period(spark, d):
    """M01"""
    return table(spark, d, "research_findings").select("finding_id", findings.canonical_period(F.col("period")).alias("period"))


@query("SELECT id, regexp_extract(filter_1, '(Q[1-4])$', 1) || ' ' || left(filter_1, 4) AS period FROM document_versions")
def document_period(spark, d):
    """Document periods are written 2026_Q1."""
    return table(spark, d, "document_versions").select("id", findings.document_period(F.col("filter_1")).alias("period"))


@query(f"SELECT finding_id, {_METRIC} AS metric FROM research_findings")
def canonical_metric(spark, d):
    """M04"""
    return table(spark, d, "research_findings").select("finding_id", findings.canonical_metric(F.col("metric_name")).alias("metric"))


@query(
    r"""WITH n AS (SELECT finding_id, coalesce(metric_name, '') || CASE finding_id % 3 WHEN 0 THEN ' – Q4/2025' WHEN 1 THEN ' - FY 24' ELSE '' END AS name, coalesce(period, '') AS period FROM research_findings)
SELECT finding_id, CASE WHEN period <> '' THEN period WHEN finding_id % 3 = 0 THEN 'Q4 2025' WHEN finding_id % 3 = 1 THEN 'FY 2024' ELSE '' END AS period FROM n"""
)
def recovered_period(spark, d):
    """Periods recovered from qualifiers that were put behind two names of three."""
    suffix = F.when(F.col("finding_id") % 3 == 0, " – Q4/2025").when(F.col("finding_id") % 3 == 1, " - FY 24").otherwise("")
    name = F.concat(F.coalesce("metric_name", F.lit("")), suffix)
    return table(spark, d, "research_findings").select("finding_id", findings.recovered_period(name, F.coalesce("period", F.lit(""))).alias("period"))


_DOC = "(SELECT id, regexp_extract(filter_1, '(Q[1-4])$', 1) || ' ' || left(filter_1, 4) AS doc_period FROM document_versions)"
_GROUPS = rf"""f AS (SELECT r.*, {_period('r.period')} AS own, coalesce(v.doc_period, '') AS doc FROM research_findings r LEFT JOIN {_DOC} v ON v.id = r.document_version_id
  WHERE coalesce(metric_name, '') <> '' AND coalesce(metric_value, '') <> ''),
g AS (SELECT trim(coalesce(bank, ''), ' ') AS entity, trim(coalesce(segment, ''), ' ') AS segment, {_METRIC} AS metric, trim(coalesce(unit, ''), ' ') AS unit, metric_value, metric_name, finding_id,
  coalesce(nullif(CASE WHEN (own <> '' AND (regexp_matches(own, '(?i)\b(?:change|qoq|yoy|vs\.?|versus|delta|growth)\b') OR regexp_matches(own, '(?i)\bq([1-4])\s*[/\s]?\s*(\d{{2,4}})\b') OR regexp_matches(own, '(?i)\bfy\s*[/\s]?\s*(\d{{2,4}})\b')))
    OR doc = '' THEN own ELSE doc END, ''), '(unspecified)') AS period FROM f)"""


def _groups(spark, d):
    v = table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"), findings.document_period(F.col("filter_1")).alias("doc_period"))
    return findings.metric_groups(table(spark, d, "research_findings").join(v, "document_version_id", "left"), F.coalesce("doc_period", F.lit("")))


@query(f"WITH {_GROUPS} SELECT finding_id, period FROM g")
def resolved_period(spark, d):
    """M03, F07"""
    return _groups(spark, d).select("finding_id", "period")


@query(f"WITH {_GROUPS} SELECT entity, segment, metric, unit, count(*) AS n_findings, count(DISTINCT period) AS n_periods FROM g GROUP BY ALL")
def metric_groups(spark, d):
    """A15"""
    return _groups(spark, d).groupBy(*findings.GROUP).agg(F.count(F.lit(1)).alias("n_findings"), F.countDistinct("period").alias("n_periods"))


_CELLS = """c AS (SELECT entity, segment, metric, unit, period, metric_value, min(finding_id) AS first FROM g GROUP BY ALL),
v AS (SELECT entity, segment, metric, unit, period, count(*)::INT AS n_values, count(*) = 1 AS values_agree, string_agg(metric_value, ' / ' ORDER BY first) AS display_value FROM c GROUP BY ALL)"""


@query(f"WITH {_GROUPS}, {_CELLS} SELECT * FROM v")
def metric_cells(spark, d):
    """A17, M08"""
    return findings.period_values(_groups(spark, d))


_PERIODS = ["Q4 2024", "FY 2024", "(unspecified)"]


@query(
    f"""WITH {_GROUPS}, {_CELLS} SELECT entity, segment, metric, unit, max(display_value) FILTER (period = 'Q4 2024') AS q4_2024,
  max(display_value) FILTER (period = 'FY 2024') AS fy_2024, max(display_value) FILTER (period = '(unspecified)') AS unspecified FROM v GROUP BY ALL"""
)
def metric_pivot(spark, d):
    """Groups with three stated periods as columns."""
    return findings.pivoted(_groups(spark, d), _PERIODS).withColumnsRenamed({"Q4 2024": "q4_2024", "FY 2024": "fy_2024", "(unspecified)": "unspecified"})


@query(rf"WITH {_GROUPS} SELECT metric, arg_min(metric_name, (NOT regexp_matches(metric_name, '\([A-Z][A-Z0-9]+\)'), length(metric_name), metric_name)) AS label FROM g GROUP BY 1")
def display_label(spark, d):
    """A18"""
    return _groups(spark, d).groupBy("metric").agg(findings.display_label().alias("label"))


@query("SELECT document_version_id, finding, page, arg_min(finding_id, (iteration, finding_id)) AS finding_id FROM research_findings GROUP BY ALL")
def combined_findings(spark, d):
    """A20"""
    return findings.deduplicated_findings(table(spark, d, "research_findings")).select("document_version_id", "finding", "page", "finding_id")


_REFS = """p AS (SELECT document_version_id, page, location_detail, min(finding_id) AS first, count(*) AS n_findings FROM research_findings GROUP BY ALL),
refs AS (SELECT document_version_id, page, location_detail, n_findings, row_number() OVER (PARTITION BY document_version_id ORDER BY first)::INT AS ref_id FROM p)"""


@query(f"WITH {_REFS} SELECT document_version_id, page, location_detail, n_findings, ref_id FROM refs")
def ref_index(spark, d):
    """A14"""
    return findings.references(table(spark, d, "research_findings"))


@query("SELECT document_version_id, array_to_string(list_sort(list(DISTINCT page)), ',') AS pages FROM research_findings WHERE page > 0 GROUP BY 1")
def cited_pages(spark, d):
    """A19"""
    return answers.cited_pages(table(spark, d, "research_findings")).withColumn("pages", F.array_join("pages", ","))


@query(
    """SELECT page_result_id FROM page_results p WHERE EXISTS (SELECT 1 FROM research_findings f WHERE f.document_version_id = p.document_version_id AND f.page = p.page_number AND f.page > 0)"""
)
def cited_evidence(spark, d):
    """J14, A19"""
    return answers.cited_evidence(table(spark, d, "page_results"), answers.cited_pages(table(spark, d, "research_findings"))).select("page_result_id")


@query(
    """SELECT DISTINCT document_version_id, page FROM research_findings f WHERE page > 0 AND NOT EXISTS (SELECT 1 FROM page_results p WHERE p.document_version_id = f.document_version_id AND p.page_number = f.page)"""
)
def uncited_pages(spark, d):
    """U03"""
    return answers.uncited_pages(table(spark, d, "research_findings"), table(spark, d, "page_results"))


@query(r"SELECT finding_id, array_to_string(regexp_extract_all(replace(coalesce(metric_value, ''), ',', ''), '(?i)\d+(?:\.\d+)?(?:%|\s*bps?)?'), ';') AS tokens FROM research_findings")
def value_tokens(spark, d):
    """M12"""
    return table(spark, d, "research_findings").select("finding_id", F.array_join(findings.value_tokens(F.col("metric_value")), ";").alias("tokens"))


@query(
    rf"""WITH {_REFS}, f AS (SELECT f.*, r.ref_id, regexp_extract_all(replace(coalesce(metric_value, ''), ',', ''), '(?i)\d+(?:\.\d+)?(?:%|\s*bps?)?') AS t
  FROM research_findings f JOIN refs r USING (document_version_id, page, location_detail))
SELECT document_version_id, finding_id, 'uncited' AS problem FROM f WHERE ref_id > 2
UNION ALL SELECT document_version_id, finding_id, 'value missing' FROM f WHERE ref_id <= 2 AND len(t) > 0 AND len(list_filter(t, lambda x: contains(replace(finding, ',', ''), x))) = 0"""
)
def coverage_audit(spark, d):
    """An answer that cites the first two places of each document; its text is the finding's own."""
    f = table(spark, d, "research_findings")
    refs = findings.references(f)
    return findings.coverage_audit(f, refs, refs.where("ref_id <= 2").select("document_version_id", "ref_id"), F.col("finding"))


@query(
    """WITH k AS (SELECT page_result_id, trim(unnest(coalesce(keywords, []) || coalesce(entities, [])), E' \\t\\r\\n') AS t, generate_subscripts(coalesce(keywords, []) || coalesce(entities, []), 1) AS i FROM page_results),
u AS (SELECT page_result_id, t, min(i) AS i FROM k WHERE t <> '' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY page_result_id ORDER BY i) AS n FROM u)
SELECT page_result_id, string_agg(t, ';' ORDER BY i) AS facets FROM r WHERE n <= 3 GROUP BY 1"""
)
def limited_facets(spark, d):
    """O11"""
    none = F.array().cast("array<string>")
    facets = answers.limited_texts(F.concat(F.coalesce("keywords", none), F.coalesce("entities", none)), 3)
    return table(spark, d, "page_results").select("page_result_id", F.array_join(facets, ";").alias("facets")).where("facets <> ''")


@query(
    r"""SELECT page_result_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(raw_content, ''),
  '\b\d+(?:\.\d+)?\s*[–-]\s*\d+(?:\.\d+)?%', 'a reported percentage range', 'g'), '\b\d+(?:\.\d+)?%', 'a reported percentage', 'g'), '(?i)\b\d+(?:\.\d+)?\s*bps?\b', 'a reported basis-point change', 'g'),
  '(?i)\b(?:CAD|USD|C\$|\$)\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion|bn|mm))?\b', 'a reported amount', 'g'), '(?i)\b\d[\d,]*(?:\.\d+)?\s*(?:million|billion|bn|mm)\b', 'a reported amount', 'g'), '\s{2,}', ' ', 'g'), ' ')) AS digest
FROM page_results"""
)
def softened_text(spark, d):
    """M19, on whole pages"""
    return table(spark, d, "page_results").select("page_result_id", F.sha2(answers.softened(F.col("raw_content")), 256).alias("digest"))


def _answers(spark, d):
    f = table(spark, d, "research_findings")
    refs = findings.references(f).join(table(spark, d, "document_versions").select(F.col("id").alias("document_version_id"), "filename"), "document_version_id")
    text = f.groupBy("document_version_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("finding_id", "finding"))), lambda x: F.concat(x["finding"], F.lit(" [REF:"), (x["finding_id"] % 5).cast("string"), F.lit("]"))), " ").alias("text"))
    return text, refs


_ANSWERS = f"""{_REFS}, r AS (SELECT refs.*, v.filename FROM refs JOIN document_versions v ON v.id = document_version_id),
f AS (SELECT document_version_id, finding_id, finding, finding_id % 5 AS n FROM research_findings),
l AS (SELECT f.document_version_id, f.finding_id, f.finding, f.n, r.filename, CASE WHEN r.ref_id IS NULL THEN '[REF:' || f.n || ']' ELSE '<a href="https://docs.local/files/' || r.filename || '#page=' || r.page || '">[' || f.n || ']</a>' END AS mark
  FROM f LEFT JOIN r ON r.document_version_id = f.document_version_id AND r.ref_id = f.n)"""


@query(
    f"""WITH {_ANSWERS} SELECT document_version_id, string_agg(finding || ' ' || mark, ' ' ORDER BY finding_id) AS text,
  coalesce(array_to_string(list_sort(list(DISTINCT n) FILTER (filename IS NOT NULL)), ','), '') AS used_refs, coalesce(array_to_string(list_sort(list(DISTINCT n) FILTER (filename IS NULL)), ','), '') AS unknown_refs FROM l GROUP BY 1"""
)
def linked_answers(spark, d):
    """Answers made of a document's findings, with links for the references that exist."""
    text, refs = _answers(spark, d)
    out = answers.linked_answers(text, refs, "document_version_id")
    return out.withColumns({"used_refs": F.array_join("used_refs", ","), "unknown_refs": F.array_join("unknown_refs", ",")})


@query(
    r"""WITH t AS (SELECT document_version_id, string_agg(finding || ' [REF:' || finding_id % 5 || ']', ' ' ORDER BY finding_id) AS text FROM research_findings GROUP BY 1),
s AS (SELECT document_version_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: contains(x, '[')) AS l FROM t)
SELECT document_version_id, array_to_string(l[1:5], chr(10)) AS sentences FROM s"""
)
def cited_sentences(spark, d):
    """O12"""
    return _answers(spark, d)[0].select("document_version_id", F.array_join(answers.cited_sentences(F.col("text")), "\n").alias("sentences"))


@query(
    """SELECT finding_id, contains(lower(replace(coalesce(finding, ''), ',', '')), 'because of') AND (contains(lower(replace(coalesce(finding, ''), ',', '')), 'higher') OR contains(lower(replace(coalesce(finding, ''), ',', '')), 'delayed')) AS passed FROM research_findings"""
)
def assertion_results(spark, d):
    """A24"""
    f = table(spark, d, "research_findings").withColumns({"all_of": F.array(F.lit("because of")), "any_of": F.array(F.lit("Higher"), F.lit("delayed"))})
    return answers.assertion_results(f, "finding", "all_of", "any_of").select("finding_id", "passed")


@query(
    """WITH f AS (SELECT document_version_id, finding_id, coalesce(finding, '') = '' OR coalesce(page, 0) = 0 OR coalesce(location_detail, '') = '' AS bad FROM research_findings)
SELECT document_version_id, bool_or(bad) AS retry FROM f GROUP BY 1"""
)
def findings_retry(spark, d):
    """F08"""
    f = table(spark, d, "research_findings")
    return f.groupBy("document_version_id").agg(F.bool_or(answers.needs_retry(F.array(F.struct("finding", "page", "location_detail")))).alias("retry"))
