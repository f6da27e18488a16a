"""Assembling and checking answers: sections, citations, anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.findings import text_or_blank

# The headings of an answer's sections and the form of its links.
SECTION_KEYS = {"Summary": "summary", "Metrics": "metrics", "Detail": "detail", "Gaps": "gaps", "Coverage": "coverage_audit"}
ANCHOR = r'(<a href="[^"]+">\[(\d+)\]</a>)(?:\1)+'


def limited_texts(values: Column, most: int) -> Column:
    """Trimmed texts without blanks and repeats, in order, the first ``most``."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.btrim(v, F.lit(" \t\r\n")))
    return F.slice(F.array_distinct(F.filter(trimmed, lambda v: v != "")), 1, most)


def softened(text: Column) -> Column:
    """A guessed answer without its numbers: percentages, basis points and amounts become neutral phrases."""
    out = text_or_blank(text)
    # fixed values: the patterns of numbers and the phrases that take their place
    for pattern, phrase in (
        (r"\b\d+(?:\.\d+)?\s*[–-]\s*\d+(?:\.\d+)?%", "a reported percentage range"),
        (r"\b\d+(?:\.\d+)?%", "a reported percentage"),
        (r"(?i)\b\d+(?:\.\d+)?\s*bps?\b", "a reported basis-point change"),
        (r"(?i)\b(?:CAD|USD|C\$|\$)\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion|bn|mm))?\b", "a reported amount"),
        (r"(?i)\b\d[\d,]*(?:\.\d+)?\s*(?:million|billion|bn|mm)\b", "a reported amount"),
        (r"\s{2,}", " "),
    ):
        out = F.regexp_replace(out, pattern, phrase)
    return F.trim(out)


def cited_sentences(summary: Column, most: int = 5) -> Column:
    return F.slice(F.filter(F.split(text_or_blank(summary), r"(?<=[.!?])\s+"), lambda s: F.contains(s, F.lit("["))), 1, most)


def answer_sections(text: Column) -> Column:
    """Map of the known ``## Heading`` sections to their text; of repeated headings the last."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), text_or_blank(text)), r"(?m)^##[ \t]+"), lambda p, i: i > 0)
    keys = F.create_map(*[F.lit(x) for pair in SECTION_KEYS.items() for x in pair])

    def entry(p: Column) -> Column:
        head = F.regexp_extract(p, r"^(\w+)", 1)
        return F.struct(keys[head].alias("key"), F.btrim(F.regexp_replace(p, r"^[^\n]*\n?", ""), F.lit(" \t\r\n")).alias("value"))

    entries = F.filter(F.transform(parts, entry), lambda e: e["key"].isNotNull())
    return F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))


def gap_items(text: Column) -> Column:
    """Lines of the gaps section without their bullets; none if it says that there are none."""
    lines = F.transform(F.split(text_or_blank(text), r"\r\n|\r|\n"), lambda x: F.trim(F.regexp_replace(x, r"^[\s*-]+", "")))
    none = text_or_blank(text).rlike(r"(?i)^\s*none\s+identified\.?\s*$")
    return F.when(none, F.array().cast("array<string>")).otherwise(F.filter(lines, lambda x: x != ""))


def without_repeated_anchors(text: Column) -> Column:
    return F.regexp_replace(text, ANCHOR, "$1")


def ref_ids(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text_or_blank(text), F.lit(r"\[REF:(\d+)\]"), 1), lambda x: x.cast("int"))


def linked_answers(answers: DataFrame, refs: DataFrame, key: str) -> DataFrame:
    """Answers (key, text) with every known [REF:n] as a link, unknown ones as they stand.

    ``refs`` has (key, ref_id, filename, page). The marks are exploded and joined, and the text is put together again in order."""
    # marks and what stands between them, in turn
    bits = F.regexp_extract_all(F.col("text"), F.lit(r"\[REF:\d+\]|(?s:(?!\[REF:\d+\]).)+"), 0)
    parts = answers.select(key, F.posexplode_outer(bits).alias("pos", "bit")).withColumn("ref_id", F.expr(r"try_cast(nullif(regexp_extract(bit, '^\\[REF:(\\d+)\\]$', 1), '') AS int)"))
    joined = parts.join(refs.select(key, "ref_id", "filename", "page"), [key, "ref_id"], "left")
    link = F.format_string('<a href="https://docs.local/files/%s#page=%d">[%d]</a>', F.col("filename"), F.col("page"), F.col("ref_id"))
    shown = joined.withColumn("bit", F.when(F.col("filename").isNotNull(), link).otherwise(F.col("bit")))
    rebuilt = shown.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "bit"))), lambda x: x["bit"]), "").alias("text"),
        F.array_sort(F.collect_set(F.when(F.col("filename").isNotNull(), F.col("ref_id")))).alias("used_refs"),
        F.array_sort(F.collect_set(F.when(F.col("filename").isNull(), F.col("ref_id")))).alias("unknown_refs"),
    )
    return rebuilt.withColumn("text", without_repeated_anchors(F.col("text")))


def uncited_pages(findings: DataFrame, chunks: DataFrame, document: str = "document_version_id") -> DataFrame:
    """(document, page) that findings name but no chunk of the evidence has."""
    return findings.where("page > 0").select(document, "page").distinct().join(chunks.select(document, F.col("page_number").alias("page")).distinct(), [document, "page"], "left_anti")


def cited_pages(refs: DataFrame, document: str = "document_version_id") -> DataFrame:
    return refs.where("page > 0").groupBy(document).agg(F.array_sort(F.collect_set("page")).alias("pages"))


def cited_evidence(evidence: DataFrame, pages: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Evidence rows whose page is cited in the same document."""
    cited = pages.select(document, F.explode("pages").alias("page_number"))
    return evidence.join(cited, [document, "page_number"], "left_semi")


def is_repeat(previous: Column, current: Column) -> Column:
    """Whether all current queries were asked before (trimmed, in any case); both must have some."""
    def plain(a: Column) -> Column:
        return F.transform(a, lambda x: F.lower(F.trim(x)))

    return (F.size(previous) > 0) & (F.size(current) > 0) & (F.size(F.array_except(plain(current), plain(previous))) == 0)


def needs_retry(findings: Column) -> Column:
    """No findings, or one without text, page or place."""
    return (F.size(findings) <= 0) | F.exists(
        findings, lambda f: (text_or_blank(f["finding"]) == "") | (F.coalesce(f["page"], F.lit(0)) == 0) | (text_or_blank(f["location_detail"]) == "")
    )


def assertion_results(answers: DataFrame, response: str, includes: str, any_of: str) -> DataFrame:
    """Answers with ``passed``: all texts of ``includes`` and one of ``any_of`` (if it has any) stand in the response, whatever the case and commas."""
    text = F.lower(F.replace(text_or_blank(F.col(response)), F.lit(","), F.lit("")))

    def held(x: Column) -> Column:
        return F.contains(text, F.lower(F.replace(x, F.lit(","), F.lit(""))))

    none = F.array().cast("array<string>")
    every, some = F.coalesce(F.col(includes), none), F.coalesce(F.col(any_of), none)
    return answers.withColumn("passed", F.forall(every, held) & ((F.size(some) == 0) | F.exists(some, held)))


def reference_appendix(refs: DataFrame, key: str = "document_version_id") -> DataFrame:
    """(key, appendix): the references of an answer as a markdown table, in the order of their numbers."""
    line = F.format_string("| %d | %s | %s | %d | %s |", "ref_id", text_or_blank(F.col("source")), text_or_blank(F.col("filename")), F.coalesce("page", F.lit(0)), text_or_blank(F.col("location_detail")))
    rows = refs.select(key, "ref_id", line.alias("_line"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ref_id", "_line"))), lambda x: x["_line"])
    head = F.array(F.lit("## References"), F.lit("| # | Source | File | Page | Location |"), F.lit("|---|--------|------|------|----------|"))
    return rows.groupBy(key).agg(F.array_join(F.concat(head, lines), "\n").alias("appendix"))


def context_sections(chunks: DataFrame, key: str = "document_version_id") -> DataFrame:
    """(key, section_id, first_page, last_page, units): the evidence grouped by section, as it is shown to a model."""
    return chunks.groupBy(key, F.coalesce("section_id", F.lit("")).alias("section_id")).agg(
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"), F.count(F.lit(1)).alias("units")
    )


def lineage(chunks: DataFrame, follow_up: DataFrame, initial: DataFrame, key: list[str]) -> DataFrame:
    """Chunks with ``origin``: that of the follow-up search if there is one, else of the first search, else ''."""
    f = follow_up.groupBy(*key).agg(F.min("origin").alias("_f"))
    i = initial.groupBy(*key).agg(F.min("origin").alias("_i"))
    return chunks.join(f, key, "left").join(i, key, "left").withColumn("origin", F.coalesce("_f", "_i", F.lit(""))).drop("_f", "_i")
