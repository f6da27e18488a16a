"""The research loop's rules and the final answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators import answers
from folioflow.operators.findings import text_or_blank

# The names of the reasons a loop ends for, and what an answer without evidence says.
NO_QUERIES, MOST_ROUNDS, REPEATED, NOTHING_NEW = "no_additional_queries", "max_iterations", "repeated_follow_up_queries", "follow_up_found_no_new_chunks"
NO_SOURCES, NO_FINDINGS = "No sources returned results.", "No findings extracted from sources."


def stop_reason(number: Column, queries: Column, previous: Column, confidence: Column, before: Column, fresh: Column, most: int) -> Column:
    """Why a loop ends after a round; NULL if it goes on. Queries that were all asked in the round before end it only if the confidence has not grown."""
    return (
        F.when(F.size(F.coalesce(queries, F.array().cast("array<string>"))) == 0, NO_QUERIES)
        .when(number >= most, MOST_ROUNDS)
        .when(answers.is_repeat(previous, queries) & (confidence <= before), REPEATED)
        .when(fresh == 0, NOTHING_NEW)
    )


def loop_rounds(rounds: DataFrame, key: str, most: int = 3) -> DataFrame:
    """(key, iteration, stop_reason) of the rounds that a loop makes, from rounds (key, iteration, queries, confidence, new_chunks): those after the first with
    a reason to stop are not made. A key has few rounds. NULL queries are none; a NULL confidence is 0."""
    w = Window.partitionBy(key).orderBy("iteration")
    confidence = F.coalesce("confidence", F.lit(0.0))
    reason = stop_reason(
        F.col("iteration"), F.col("queries"), F.coalesce(F.lag("queries").over(w), F.array().cast("array<string>")), confidence, F.coalesce(F.lag(confidence).over(w), F.lit(0.0)), F.coalesce("new_chunks", F.lit(0)), most
    )
    told = rounds.select(key, "iteration", reason.alias("stop_reason"))
    ended = F.count("stop_reason").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return told.withColumn("_ended", ended).where("_ended = 0").drop("_ended")


def final_answers(units: DataFrame, sources: DataFrame, findings: DataFrame, write: Callable[[DataFrame], DataFrame], key: str = "document_version_id") -> DataFrame:
    """(key, response, summary_answer, metrics_table, detailed_summary, key_findings, data_gaps, n_references) of every unit.

    A unit without sources, or whose sources gave no findings, gets no answer but a data gap that says so, and is not written; for the others ``write`` maps
    (key, inventory), the findings with their reference marks, to (key, text), whose sections are read. NULL texts are empty."""
    refs = findings.groupBy(key, "page", "location_detail").agg(F.min("finding_id").alias("_first"), F.min_by("finding", "finding_id").alias("finding"))
    refs = refs.withColumn("ref_id", F.row_number().over(Window.partitionBy(key).orderBy("_first")))
    line = F.format_string("[REF:%d] %s", F.col("ref_id"), text_or_blank(F.col("finding")))
    inventory = refs.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_id", line.alias("l")))), lambda x: x["l"]), "\n").alias("inventory"), F.count(F.lit(1)).alias("n_references"))
    written = write(inventory.select(key, "inventory")).select(key, F.col("text").alias("_text"))
    joined = units.select(key).join(sources.select(key).distinct().withColumn("_sourced", F.lit(True)), key, "left").join(inventory.drop("inventory"), key, "left").join(written, key, "left")
    none = F.array().cast("array<string>")
    parts = joined.withColumn("_parts", answers.answer_sections(text_or_blank(F.col("_text"))))

    def part(name: str) -> Column:
        return text_or_blank(F.col("_parts")[name])

    gaps = F.when(F.col("_sourced").isNull(), F.array(F.lit(NO_SOURCES))).when(F.col("n_references").isNull(), F.array(F.lit(NO_FINDINGS))).otherwise(answers.gap_items(part("gaps")))
    return parts.select(
        key,
        text_or_blank(F.col("_text")).alias("response"),
        part("summary").alias("summary_answer"),
        part("metrics").alias("metrics_table"),
        part("detail").alias("detailed_summary"),
        F.when(part("summary") == "", none).otherwise(answers.cited_sentences(part("summary"))).alias("key_findings"),
        gaps.alias("data_gaps"),
        F.coalesce("n_references", F.lit(0)).alias("n_references"),
    )


#: What leaves the engine of a result; traces and audit fields stay inside.
PUBLIC = ("query", "response", "key_findings", "data_gaps", "citation_warnings", "summary_answer", "metrics_table", "detailed_summary")


def public_json(results: DataFrame, key: str, fields: tuple[str, ...] = PUBLIC) -> DataFrame:
    """(key, json): the fields of a result that are passed on, as JSON; missing ones are left out, NULLs are blank texts or empty lists."""
    def shown(name: str) -> Column:
        is_list = dict(results.dtypes)[name].startswith("array")
        return F.coalesce(F.col(name), F.array().cast(dict(results.dtypes)[name]) if is_list else F.lit("")).alias(name)

    return results.select(key, F.to_json(F.struct(*[shown(f) for f in fields if f in results.columns])).alias("json"))


def inventory_text(cells: DataFrame, group: tuple[str, ...]) -> DataFrame:
    """(entity, text): the metrics of each entity as lines ``metric [segment] (unit): period value; ...`` with differing values marked, in order."""
    value = F.concat(F.col("period"), F.lit(" "), F.col("display_value"), F.when(F.col("values_agree"), "").otherwise(" (differ)"))
    lines = cells.groupBy(*group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("period", value.alias("v")))), lambda x: x["v"]), "; ").alias("_v"))
    line = F.concat(F.col("metric"), F.when(F.col("segment") != "", F.concat(F.lit(" ["), F.col("segment"), F.lit("]"))).otherwise(""), F.when(F.col("unit") != "", F.concat(F.lit(" ("), F.col("unit"), F.lit(")"))).otherwise(""), F.lit(": "), F.col("_v"))
    return lines.select("entity", line.alias("_l")).groupBy("entity").agg(F.array_join(F.array_sort(F.collect_list("_l")), "\n").alias("text"))
