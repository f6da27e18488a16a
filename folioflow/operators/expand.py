"""Surrounding context of hits: reading order, neighbours, sections, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECTION_LIMIT, SUBSECTION_LIMIT, NEIGHBOURS, SMALL_DOCUMENT = 6000, 3000, 4, 80_000


def reading_key(page: Column, unit: Column) -> Column:
    """Sorts units as they are read: by page, then by the numbers in the id; parts that are no numbers count as 0, the id itself decides last."""
    def part(i: int) -> Column:
        return F.coalesce(F.try_element_at(F.split(unit, r"\."), F.lit(i)).try_cast("int"), F.lit(0))

    return F.struct(page.alias("p"), part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), unit.alias("u"))


def numbered(units: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Units with their place in the reading order of their document, from 1."""
    return units.withColumn("place", F.row_number().over(Window.partitionBy(document).orderBy(reading_key(F.col("page_number"), F.col("content_unit_id")))))


def neighbours(units: DataFrame, targets: DataFrame, n: int = NEIGHBOURS, document: str = "document_version_id") -> DataFrame:
    """(document, trigger, units...) of the units at most ``n`` places from each target, itself included. One numbering serves all
    targets, and every target names the places it wants, so this is an equi-join."""
    placed = numbered(units, document)
    wanted = (
        targets.select(document, F.col("content_unit_id").alias("trigger"))
        .join(placed.select(document, F.col("content_unit_id").alias("trigger"), F.col("place").alias("_at")), [document, "trigger"])
        .select(document, "trigger", F.explode(F.sequence(F.col("_at") - n, F.col("_at") + n)).alias("place"))
    )
    return wanted.join(placed, [document, "place"])


def section_sizes(units: DataFrame, document: str = "document_version_id") -> DataFrame:
    return units.where(F.coalesce("section_id", F.lit("")) != "").groupBy(document, "section_id").agg(F.sum(F.coalesce("token_count", F.lit(0))).alias("section_tokens"))


def expansion_strategies(units: DataFrame, sections: DataFrame, section_limit: int = SECTION_LIMIT, subsection_limit: int = SUBSECTION_LIMIT, document: str = "document_version_id") -> DataFrame:
    """Each unit's way of expansion: ``full_section`` if its root section is small enough, else ``subsection`` if the section that holds
    it is a small enough child, else ``neighbours``.

    ``sections`` has (document, section_id, parent_section_id, token_count); a section without a parent is its own root."""
    own = sections.select(document, "section_id", F.coalesce("parent_section_id", F.lit("")).alias("_parent"), F.col("token_count").alias("_tokens"))
    root = sections.select(document, F.col("section_id").alias("_root"), F.col("token_count").alias("_root_tokens"))
    joined = units.join(own, [document, "section_id"], "left").withColumn("_root", F.when(F.col("_parent") != "", F.col("_parent")).otherwise(F.col("section_id")))
    joined = joined.join(root, [document, "_root"], "left")
    strategy = (
        F.when(F.col("_root_tokens") <= section_limit, "full_section")
        .when((F.col("_parent") != "") & (F.col("_tokens") <= subsection_limit), "subsection")
        .otherwise("neighbours")
    )
    return joined.withColumn("strategy", strategy).drop("_parent", "_tokens", "_root_tokens").withColumnRenamed("_root", "root_section_id")


def expanded(units: DataFrame, planned: DataFrame, n: int = NEIGHBOURS, document: str = "document_version_id") -> DataFrame:
    """(document, trigger, strategy, content_unit_id, score, is_original): the units that the planned hits bring in. A hit whose section
    brings nothing in gets its neighbours. Only the hit's own row carries its score."""
    hits = planned.select(document, F.col("content_unit_id").alias("trigger"), "strategy", "root_section_id", "section_id", F.col("score").alias("_score"))
    parents = units.select(document, "content_unit_id", F.col("section_id").alias("_sid"), F.col("root_section_id").alias("_rid"))
    whole = hits.where("strategy = 'full_section'").join(parents.withColumnRenamed("_rid", "root_section_id"), [document, "root_section_id"])
    part = hits.where("strategy = 'subsection'").join(parents.withColumnRenamed("_sid", "section_id"), [document, "section_id"])
    near = neighbours(units, hits.where("strategy = 'neighbours'").select(document, F.col("trigger").alias("content_unit_id")), n, document)
    near = near.select(document, "trigger", "content_unit_id").join(hits.where("strategy = 'neighbours'"), [document, "trigger"])
    cols = [document, "trigger", "strategy", "content_unit_id", "_score"]
    rows = whole.select(*cols).unionByName(part.select(*cols)).unionByName(near.select(*cols))
    own = F.col("trigger") == F.col("content_unit_id")
    return rows.select(document, "trigger", "strategy", "content_unit_id", F.when(own, F.col("_score")).otherwise(0.0).alias("score"), own.alias("is_original"))


def deduplicated(chunks: DataFrame, document: str = "document_version_id") -> DataFrame:
    """One row for each unit: original if any of its rows is, the highest score, the triggers that brought it in."""
    return chunks.groupBy(document, "content_unit_id").agg(
        F.bool_or("is_original").alias("is_original"), F.max("score").alias("score"), F.sort_array(F.collect_set("trigger")).alias("triggers")
    )


def small_or_searched(units: DataFrame, fused: DataFrame, limit: int = SMALL_DOCUMENT, document: str = "document_version_id") -> DataFrame:
    """(document, content_unit_id, score): all units, with score 1, of the documents within the limit, the fused hits of the others."""
    totals = units.groupBy(document).agg(F.coalesce(F.sum("token_count"), F.lit(0)).alias("_total"))
    small = units.join(totals.where(F.col("_total") <= limit), document).select(document, "content_unit_id", F.lit(1.0).alias("score"))
    large = fused.join(totals.where(F.col("_total") <= limit).select(document), document, "left_anti").select(document, "content_unit_id", "score")
    return small.unionByName(large)


def unseen_hits(hits: DataFrame, seen: DataFrame, document: str = "document_version_id") -> DataFrame:
    """Follow-up hits that are not known yet; of repeated ones the first by (query_no, rank)."""
    fresh = hits.join(seen.select(document, "content_unit_id").distinct(), [document, "content_unit_id"], "left_anti")
    rest = [c for c in hits.columns if c not in (document, "content_unit_id")]
    return fresh.groupBy(document, "content_unit_id").agg(F.min_by(F.struct(*rest), F.struct("query_no", "rank")).alias("_h")).select(document, "content_unit_id", "_h.*")


def evidence_catalog(chunks: DataFrame, document: str = "document_version_id") -> DataFrame:
    """The first unit in reading order for each (page, section) of a document."""
    order = reading_key(F.col("page_number"), F.col("content_unit_id"))
    return chunks.groupBy(document, "page_number", "section_id").agg(F.min_by("content_unit_id", order).alias("content_unit_id"))
