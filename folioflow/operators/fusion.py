"""Normalising, fusing and cutting the hits of several strategies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.ranks import HOT_ROWS, row_numbers
from folioflow.session import small_side

# The strategies' names and weights.
WEIGHTS = {
    "content_vector": 0.25, "hyde_vector": 0.20, "subquery_vector": 0.15, "keyword_vector": 0.10,
    "section_summary": 0.10, "bm25": 0.12, "keyword_array": 0.07, "entity_array": 0.01,
}
#: Order in which a unit's payload and ties are taken.
STRATEGIES = ("content_vector", "hyde_vector", "keyword_vector", "subquery_vector", "section_summary", "bm25", "keyword_array", "entity_array")


#: Stands for hot queries that were not looked for yet.
UNKNOWN = object()


def hot_queries(hits: DataFrame, query: str = "query_id", hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The queries of more than ``hot_rows`` hits; None if there are none, which is the rule."""
    counts = hits.groupBy(query).agg(F.count(F.lit(1)).alias("_n"))
    most = counts.agg(F.max("_n")).head()[0]
    return counts.where(F.col("_n") > hot_rows).select(query) if (most or 0) > hot_rows else None


def normalised_hits(hits: DataFrame, query: str = "query_id", unit: str = "content_unit_id", hot=UNKNOWN) -> DataFrame:
    """(query, strategy, sub_query, unit, normalised): scores over the list's maximum, distances as 1 minus that; 1 if the maximum is
    0 or a hit has no value; of repeated units the largest. Sub-queries are lists of their own and share their strategy's weight.

    One shuffle by query serves everything that follows. Of a hot query the maxima are aggregates that are joined back, so it is spread."""
    hot = hot_queries(hits, query) if hot is UNKNOWN else hot
    rows = hits.where(F.col(query).isNotNull() & F.col(unit).isNotNull() & F.col("strategy").isNotNull()).select(
        query, "strategy", F.coalesce("sub_query", F.lit(0)).alias("sub_query"), unit, "score", "distance"
    )
    if hot is None:
        return _normalised_by_query(rows.repartition(query), query, unit)
    hot = small_side(hot)
    usual = _normalised_by_query(rows.join(hot, query, "left_anti").repartition(query), query, unit)
    return usual.unionByName(_normalised_by_joins(rows.join(hot, query, "left_semi"), query, unit))


def _best_hits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max("score").alias("score"), F.min("distance").alias("distance"), F.max("distance").alias("_far"))


def _with_values(best: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_score = F.when(F.col("_s") == 0, 1.0).otherwise(F.col("score") / F.col("_s"))
    by_distance = F.when(F.col("_d") == 0, 1.0).otherwise(1 - F.col("distance") / F.col("_d"))
    value = F.when(F.col("distance").isNotNull(), by_distance).when(F.col("score").isNotNull(), by_score).otherwise(1.0)
    return best.select(*keys, value.alias("normalised"), "_lists")


def _normalised_by_query(rows: DataFrame, query: str, unit: str) -> DataFrame:
    keys = [query, "strategy", "sub_query", unit]
    lists = Window.partitionBy(query, "strategy", "sub_query")
    best = _best_hits(rows, keys).withColumns({"_s": F.max("score").over(lists), "_d": F.max("_far").over(lists)})
    # a strategy has a few sub-queries
    return _with_values(best.withColumn("_lists", F.size(F.collect_set("sub_query").over(Window.partitionBy(query, "strategy")))), keys)


def _normalised_by_joins(rows: DataFrame, query: str, unit: str) -> DataFrame:
    keys = [query, "strategy", "sub_query"]
    top = rows.groupBy(*keys).agg(F.max("score").alias("_s"), F.max("distance").alias("_d"))
    lists = top.groupBy(query, "strategy").agg(F.count(F.lit(1)).cast("int").alias("_lists"))
    return _with_values(_best_hits(rows, [*keys, unit]).join(top.join(lists, [query, "strategy"]), keys), [*keys, unit])


def weight_of(weights: Mapping[str, float]) -> Column:
    """The strategy's weight; 0 for one that is not listed."""
    pairs = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
    return F.coalesce(F.create_map(*pairs)[F.col("strategy")], F.lit(0.0))


def fused(hits: DataFrame, weights: Mapping[str, float] = WEIGHTS, query: str = "query_id", unit: str = "content_unit_id", hot=UNKNOWN) -> DataFrame:
    """(query, unit, score, strategy_scores): the weighted sum of a unit's normalised values, and its parts by strategy."""
    normal = normalised_hits(hits, query, unit, hot)
    share = F.col("normalised") / F.col("_lists")
    by_strategy = normal.groupBy(query, unit, "strategy").agg(F.sum(share).alias("part"))
    entry = F.struct("strategy", F.col("part"))
    return by_strategy.groupBy(query, unit).agg(
        F.sum(weight_of(weights) * F.col("part")).alias("score"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("strategy_scores")
    )


def ranked(scored: DataFrame, query: str = "query_id", unit: str = "content_unit_id", k: int | None = None, hot=UNKNOWN) -> DataFrame:
    """Positions by score, ties by unit; with ``k`` the first of each query, of which every task keeps only its own ``k``."""
    order = [F.round("score", 9).desc(), F.col(unit)]
    if k is None:
        return row_numbers(scored, [query], order, "position", hot=hot_queries(scored, query) if hot is UNKNOWN else hot)
    return scored.withColumn("position", F.row_number().over(Window.partitionBy(query).orderBy(*order))).where(F.col("position") <= k)


def dominant_strategies(scored: DataFrame, weights: Mapping[str, float] = WEIGHTS, order: Sequence[str] = STRATEGIES, query: str = "query_id", unit: str = "content_unit_id") -> DataFrame:
    """(query, strategy, units): how many units each strategy gives the largest part of; ties go to the strategy first in ``order``."""
    position = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("strategy"))
    parts = scored.select(query, unit, F.explode("strategy_scores").alias("strategy", "part"))
    best = parts.groupBy(query, unit).agg(F.max_by("strategy", F.struct(F.round(weight_of(weights) * F.col("part"), 9), -position)).alias("strategy"))
    return best.groupBy(query, "strategy").agg(F.count(F.lit(1)).alias("units"))


def first_payload(hits: DataFrame, payload: Sequence[str], order: Sequence[str] = STRATEGIES, query: str = "query_id", unit: str = "content_unit_id") -> DataFrame:
    """One payload for each unit: that of the strategy first in ``order``."""
    position = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("strategy"))
    row = F.struct(*[F.col(c) for c in payload])
    return hits.groupBy(query, unit).agg(F.min_by(row, F.struct(position, row)).alias("_p")).select(query, unit, "_p.*")


def kept_by_judge(candidates: DataFrame, removed: DataFrame, minimum: int, query: str = "query_id") -> DataFrame:
    """Candidates without those at the removed positions; the best removed ones come back until ``minimum`` are kept, unless there are
    not that many at all. Removed positions that no candidate has are ignored; a query that the judge gave no answer for keeps all.

    Candidates are a cut list, so a query has few of them: flags and counts are made where its candidates are."""
    marks = removed.groupBy(query).agg(F.collect_set("position").alias("_marks"))
    flagged = candidates.join(marks, query, "left").withColumn("_removed", F.coalesce(F.array_contains("_marks", F.col("position")), F.lit(False)))
    own = Window.partitionBy(query)
    counted = flagged.withColumns({
        "_n": F.count(F.lit(1)).over(own),
        "_kept": F.count_if(~F.col("_removed")).over(own),
        "_place": F.row_number().over(Window.partitionBy(query, "_removed").orderBy("position")),
    })
    back = F.col("_removed") & (F.col("_n") >= minimum) & (F.col("_place") <= minimum - F.col("_kept"))
    return counted.withColumn("restored", back).where(~F.col("_removed") | F.col("restored")).drop("_marks", "_removed", "_n", "_kept", "_place")


def score_summary(scored: DataFrame, query: str = "query_id") -> DataFrame:
    return scored.groupBy(query).agg(
        F.round(F.min("score"), 4).alias("score_min"), F.round(F.max("score"), 4).alias("score_max"), F.round(F.avg("score"), 4).alias("score_mean")
    )
