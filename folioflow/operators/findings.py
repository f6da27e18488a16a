"""Findings: canonical names and periods, references, pivoted metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DASH = "[—–-]"
# The patterns of periods, comparisons and units, of names with their abbreviation and of numbers, as the canonical forms are
# defined. SUFFIX is one alternation since several qualifiers may follow each other in any order.
DELTA = r"(?i)\b(?:change|qoq|yoy|vs\.?|versus|delta|growth)\b"
QUARTER = r"(?i)\bq([1-4])\s*[/\s]?\s*(\d{2,4})\b"
FISCAL = r"(?i)\bfy\s*[/\s]?\s*(\d{2,4})\b"
SUFFIX = rf"(?i)(?:\s*{_DASH}\s*(?:prior\s+(?:quarter|year|period)|q[1-4]\s*[/\s]\s*\d{{2,4}}|fy\s*\d{{2,4}}|(?:yoy|qoq)(?:\s+change)?)\s*)+$"
UNIT_PARENS = r"(?i)\s*\((?:\$mm|\$b|%|bps|x|#|millions?|billions?)\)\s*$"
LONG_FORM = r"(?:[A-Z][a-zA-Z0-9]*\s+)(?:(?:[A-Za-z][a-zA-Z0-9]*|\d+)\s+)*\(([A-Z][A-Z0-9]+)\)"
VALUE_TOKEN = r"(?i)\d+(?:\.\d+)?(?:%|\s*bps?)?"


def text_or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapsed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text_or_blank(text), r"\s+", " "))


def full_year(year: Column) -> Column:
    return F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)


def canonical_period(period: Column) -> Column:
    """``Q1 2026`` or ``FY 2025`` where a quarter or fiscal year is named; comparisons and other texts with their white space collapsed; '' for NULL."""
    text = collapsed(period)
    quarter = F.concat(F.lit("Q"), F.regexp_extract(text, QUARTER, 1), F.lit(" "), full_year(F.regexp_extract(text, QUARTER, 2)))
    fiscal = F.concat(F.lit("FY "), full_year(F.regexp_extract(text, FISCAL, 1)))
    return F.when(text.rlike(DELTA), text).when(text.rlike(QUARTER), quarter).when(text.rlike(FISCAL), fiscal).otherwise(text)


def document_period(period: Column) -> Column:
    """``2026-q1`` and ``q1-26`` (with - _ or /) as ``Q1 2026``; other texts like any period."""
    text = F.lower(F.trim(text_or_blank(period)))
    first, second = r"^(\d{4})[-_/](q[1-4])", r"^(q[1-4])[-_/](\d{2,4})"
    return (
        F.when(text.rlike(first), F.concat(F.upper(F.regexp_extract(text, first, 2)), F.lit(" "), F.regexp_extract(text, first, 1)))
        .when(text.rlike(second), F.concat(F.upper(F.regexp_extract(text, second, 1)), F.lit(" "), full_year(F.regexp_extract(text, second, 2))))
        .otherwise(canonical_period(period))
    )


def resolved_period(period: Column, document: Column) -> Column:
    """A finding's period; the document's where it is blank or names neither quarter, fiscal year nor comparison."""
    own = canonical_period(period)
    clear = (own != "") & (own.rlike(DELTA) | own.rlike(QUARTER) | own.rlike(FISCAL))
    return F.when(clear | (document == ""), own).otherwise(document)


def canonical_metric(name: Column) -> Column:
    """Comparable key of a metric's name: no period or unit qualifiers at the end, long forms replaced by their abbreviation, lower case."""
    text = F.regexp_replace(F.trim(text_or_blank(name)), SUFFIX, "")
    text = F.regexp_replace(text, UNIT_PARENS, "")
    return F.lower(collapsed(F.regexp_replace(text, LONG_FORM, "$1")))


def recovered_period(name: Column, period: Column) -> Column:
    """The period, or, where it is blank, that in the qualifier at the end of the metric's name."""
    quarter, fiscal = rf"(?i)\s*{_DASH}\s*q([1-4])\s*[/\s]\s*(\d{{2,4}})\s*$", rf"(?i)\s*{_DASH}\s*fy\s*(\d{{2,4}})\s*$"
    found = F.when(
        name.rlike(quarter), F.concat(F.lit("Q"), F.regexp_extract(name, quarter, 1), F.lit(" "), full_year(F.regexp_extract(name, quarter, 2)))
    ).when(name.rlike(fiscal), F.concat(F.lit("FY "), full_year(F.regexp_extract(name, fiscal, 1))))
    return F.when(text_or_blank(period) != "", period).otherwise(F.coalesce(found, F.lit("")))


def is_quantitative() -> Column:
    return (text_or_blank(F.col("metric_name")) != "") & (text_or_blank(F.col("metric_value")) != "")


def deduplicated_findings(findings: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Of findings with the same document, text and page the first by (iteration, finding_id)."""
    rest = [c for c in findings.columns if c not in (document, "finding", "page")]
    order = F.struct("iteration", "finding_id")
    return findings.groupBy(document, "finding", "page").agg(F.min_by(F.struct(*rest), order).alias("_f")).select(document, "finding", "page", "_f.*")


def references(findings: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, page, location_detail, ref_id, n_findings): the places that findings name, numbered within their document in the
    order in which they are first named. Counting is an aggregation; only the places, not the findings, are numbered."""
    places = findings.groupBy(document, "page", "location_detail").agg(F.min("finding_id").alias("_first"), F.count(F.lit(1)).alias("n_findings"))
    return places.withColumn("ref_id", F.row_number().over(Window.partitionBy(document).orderBy("_first"))).drop("_first")


def metric_groups(findings: DataFrame, document_period_col: Column) -> DataFrame:
    """Quantitative findings with their group: entity, segment, canonical metric, unit and resolved period (``(unspecified)`` if blank)."""
    return findings.where(is_quantitative()).select(
        F.trim(text_or_blank(F.col("bank"))).alias("entity"),
        F.trim(text_or_blank(F.col("segment"))).alias("segment"),
        canonical_metric(F.col("metric_name")).alias("metric"),
        F.trim(text_or_blank(F.col("unit"))).alias("unit"),
        F.coalesce(F.nullif(resolved_period(F.col("period"), document_period_col), F.lit("")), F.lit("(unspecified)")).alias("period"),
        "metric_value",
        "metric_name",
        "finding_id",
    )


GROUP = ("entity", "segment", "metric", "unit")


def period_values(groups: DataFrame) -> DataFrame:
    """(group, period, n_values, values_agree, display_value): the distinct values of each cell, in the order of their first finding."""
    once = groups.groupBy(*GROUP, "period", "metric_value").agg(F.min("finding_id").alias("_first"))
    values = F.transform(F.array_sort(F.collect_list(F.struct("_first", "metric_value"))), lambda x: x["metric_value"])
    cells = once.groupBy(*GROUP, "period").agg(values.alias("_v"))
    return cells.select(*GROUP, "period", F.size("_v").alias("n_values"), (F.size("_v") == 1).alias("values_agree"), F.array_join("_v", " / ").alias("display_value"))


def pivoted(groups: DataFrame, periods: Sequence[str]) -> DataFrame:
    """One row for each group, one column for each of the stated periods: its values, joined."""
    cells = period_values(groups)
    return cells.groupBy(*GROUP).pivot("period", list(periods)).agg(F.first("display_value"))


def display_label() -> Column:
    """Aggregate: of a group's labels one with an abbreviation in parentheses, then the shortest, then the first in order."""
    name = F.col("metric_name")
    return F.min(F.struct(~name.rlike(r"\([A-Z][A-Z0-9]+\)"), F.length(name), name.alias("label")))["label"]


def value_tokens(value: Column) -> Column:
    """Numbers of a value, with % or bps if they have it, without thousands separators."""
    return F.regexp_extract_all(F.replace(text_or_blank(value), F.lit(","), F.lit("")), F.lit(VALUE_TOKEN), 0)


def coverage_audit(findings: DataFrame, refs: DataFrame, used: DataFrame, text: Column, document: str = "document_version_id") -> DataFrame:
    """(document, finding_id, problem): findings whose place the answer does not cite (``uncited``), and findings at cited places none of
    whose numbers stands in the answer's text (``value missing``). Findings without numbers count as covered."""
    placed = findings.join(refs.select(document, "page", "location_detail", "ref_id"), [document, "page", "location_detail"])
    uncited = placed.join(used, [document, "ref_id"], "left_anti").select(document, "finding_id", F.lit("uncited").alias("problem"))
    cited = placed.join(used, [document, "ref_id"], "left_semi").withColumn("_t", value_tokens(F.col("metric_value")))
    answer = F.replace(text, F.lit(","), F.lit(""))
    missing = cited.where((F.size("_t") > 0) & ~F.exists("_t", lambda t: F.contains(answer, t)))
    return uncited.unionByName(missing.select(document, "finding_id", F.lit("value missing").alias("problem")))


def source_refs(groups: DataFrame, refs: DataFrame) -> DataFrame:
    """(group, period, metric_value, sources): who states a value, ``source [REF:n]`` once each in the order of the findings."""
    placed = groups.join(refs.select("finding_id", "source", "ref_id"), "finding_id", "left")
    label = F.when(F.col("ref_id").isNotNull(), F.format_string("%s [REF:%d]", F.coalesce("source", F.lit("")), F.col("ref_id"))).otherwise(F.coalesce("source", F.lit("")))
    once = placed.groupBy(*GROUP, "period", "metric_value", label.alias("_label")).agg(F.min("finding_id").alias("_first"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_first", "_label"))), lambda x: x["_label"]), "; ")
    return once.groupBy(*GROUP, "period", "metric_value").agg(joined.alias("sources"))


def parsed_findings(payload: Column) -> Column:
    """Findings from a model's JSON; NULL where the text is no JSON of the schema."""
    from folioflow.schemas import PROVIDER_ANSWERS, struct

    return F.from_json(payload, struct(PROVIDER_ANSWERS["research"]))["findings"]


def is_valid_finding(f: Column) -> Column:
    """The three required fields are there; optional ones may be missing but not blank."""
    required = (text_or_blank(f["finding"]) != "") & (F.coalesce(f["page"], F.lit(0)) > 0) & (text_or_blank(f["location_detail"]) != "")
    for name in ("metric_name", "metric_value", "unit", "period", "segment"):
        required = required & (f[name].isNull() | (F.trim(f[name]) != ""))
    return required
