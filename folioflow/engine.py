"""The whole question path on tables: prepare, search, fuse, judge, expand, follow up."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.operators import expand, fusion, lexical, research, store, vector
from folioflow.providers import embedded


@dataclass(frozen=True)
class Options:
    top_k: int = 20
    text_top_k: int = 20
    candidates: int = 30
    minimum: int = 10
    neighbours: int = 4
    section_limit: int = 6000
    subsection_limit: int = 3000
    iterations: int = 3
    weights: dict[str, float] = field(default_factory=lambda: dict(fusion.WEIGHTS))


def document_content(pages: DataFrame) -> DataFrame:
    """Content rows with vectors of text and keywords, and one key for each unit."""
    rows = store.content_rows(pages).withColumn("unit", F.concat_ws("#", "document_version_id", "content_unit_id"))
    rows = embedded(rows, "raw_content", into="content_vector").withColumn("_k", F.array_join("keywords", " "))
    return embedded(rows, "_k", into="keyword_vector").drop("_k")


def search(content: DataFrame, questions: DataFrame, options: Options = Options()) -> DataFrame:
    """(query_id, content_unit_id, score, strategy_scores, position): the fused hits of each question.

    ``questions`` has (query_id, text). Vector strategies search text and keyword vectors, BM25 the text; each keeps its own best."""
    asked = embedded(questions, "text", into="vector")

    def near(column: str, strategy: str) -> DataFrame:
        hits = vector.nearest(content.select("unit", F.col(column).alias("vector")), asked.select(F.col("query_id").alias("query"), "vector"), options.top_k)
        return hits.select(F.col("query").alias("query_id"), F.lit(strategy).alias("strategy"), F.lit(None).cast("int").alias("sub_query"), F.col("unit").alias("content_unit_id"), F.lit(None).cast("double").alias("score"), "distance")

    words = questions.select("query_id", lexical.terms_of(F.col("text")).alias("terms"))
    text = lexical.bm25(content, words, "unit", "raw_content", options.text_top_k)
    text = text.select("query_id", F.lit("bm25").alias("strategy"), F.lit(None).cast("int").alias("sub_query"), F.col("unit").alias("content_unit_id"), "score", F.lit(None).cast("double").alias("distance"))
    hits = near("content_vector", "content_vector").unionByName(near("keyword_vector", "keyword_vector")).unionByName(text)
    return fusion.ranked(fusion.fused(hits, options.weights), k=options.candidates)


def context(content: DataFrame, hits: DataFrame, options: Options = Options()) -> DataFrame:
    """(query_id, document_version_id, content_unit_id, score, is_original): the hits with their surroundings, each unit once for a question."""
    parent = F.when(F.contains("section_id", F.lit(".")), F.split("section_id", r"\.")[0]).otherwise("")
    sections = expand.section_sizes(content).select("document_version_id", "section_id", F.col("section_tokens").alias("token_count"), parent.alias("parent_section_id"))
    planned = expand.expansion_strategies(content, sections, options.section_limit, options.subsection_limit)
    found = hits.select("query_id", F.col("content_unit_id").alias("unit"), "score")
    triggers = planned.join(found.select("unit").distinct(), "unit").withColumn("score", F.lit(0.0))
    grown = expand.expanded(planned, triggers, options.neighbours).withColumn("unit", F.concat_ws("#", "document_version_id", "trigger")).drop("score")
    joined = grown.join(found, "unit").withColumn("score", F.when(F.col("is_original"), F.col("score")).otherwise(0.0))
    return joined.groupBy("query_id", "document_version_id", "content_unit_id").agg(F.bool_or("is_original").alias("is_original"), F.max("score").alias("score"))


def retrieve(pages: DataFrame, questions: DataFrame, options: Options = Options()) -> DataFrame:
    """Questions answered with evidence: search and context in one plan."""
    content = document_content(pages)
    return context(content, search(content, questions, options), options)


def follow_up(content: DataFrame, questions: DataFrame, more, options: Options = Options(), told=None) -> DataFrame:
    """Hits of the questions and of the follow-up questions that ``more`` asks after each round, until it asks none, the rounds are used up, it asks again
    what it asked the round before without more confidence, or nothing new is found. ``more`` maps (round, hits) to (a DataFrame (query_id, text) or None, the confidence
    so far); ``told`` is called with the reason."""
    from folioflow.session import checkpointed

    seen = checkpointed(search(content, questions, options).select("query_id", "content_unit_id", "score"))
    before, confidence, reason = set(), 0.0, research.MOST_ROUNDS
    for number in range(options.iterations):
        following, sure = more(number, seen)
        texts = {r[0].strip().lower() for r in following.select("text").collect()} if following is not None else set()  # the run's own few questions
        if not texts:
            reason = research.NO_QUERIES
            break
        if number + 1 >= options.iterations:
            break
        if texts <= before and sure <= confidence:
            reason = research.REPEATED
            break
        fresh = search(content, following, options).select("query_id", "content_unit_id", "score")
        fresh = checkpointed(fresh.join(seen.select("query_id", "content_unit_id"), ["query_id", "content_unit_id"], "left_anti"))
        if not fresh.take(1):
            reason = research.NOTHING_NEW
            break
        before, confidence = texts, sure
        seen = checkpointed(seen.unionByName(fresh))
    if told is not None:
        told(reason)
    return seen
