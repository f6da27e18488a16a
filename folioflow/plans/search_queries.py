"""Queries of the retrieval operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions.vectors import cosine_distance
from folioflow.operators import expand, fusion, lexical, store, vector
from folioflow.session import small_side, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _vectors(spark, d):
    e = table(spark, d, "embeddings")
    content = e.select(F.col("vec_id").alias("unit"), F.col("embedding").alias("vector"))
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return content, asked


_TOPK = """WITH pairs AS (SELECT q.vec_id AS query, e.vec_id AS unit, list_cosine_distance(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS distance
  FROM embeddings q JOIN embeddings e ON len(q.embedding) = len(e.embedding) WHERE q.vec_id % 100 = 0),
top AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(distance, 9), unit) AS rank FROM pairs QUALIFY rank <= 20)"""


@query(f"{_TOPK} SELECT query, unit, round(distance, 6) AS distance, rank FROM top")
def vec_topk(spark, d):
    """The 20 nearest rows of every query."""
    return vector.nearest(*_vectors(spark, d)).select("query", "unit", F.round("distance", 6).alias("distance"), "rank")


@query(
    """SELECT q.vec_id AS query, e.vec_id AS unit, round(list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS distance
FROM embeddings e JOIN embeddings q ON len(q.embedding) = len(e.embedding) WHERE q.vec_id % 100 = 0"""
)
def vec_distance(spark, d):
    """R01 as an expression, for every query vector."""
    content, asked = _vectors(spark, d)
    pairs = content.join(small_side(asked.select("query", F.col("vector").alias("q"))), F.size("vector") == F.size("q"))
    return pairs.select("query", "unit", F.round(cosine_distance(F.col("vector"), F.col("q")), 6).alias("distance"))


@query(
    f"""{_TOPK}, g AS (SELECT vec_id // 500 AS questions, count(*) AS parts FROM embeddings WHERE vec_id % 100 = 0 GROUP BY 1),
n AS (SELECT query // 500 AS questions, unit, 1 - distance / max(distance) OVER (PARTITION BY query) AS v FROM top)
SELECT questions, unit, round(sum(v / parts), 6) AS score FROM n JOIN g USING (questions) GROUP BY 1, 2"""
)
def vec_topk_multi(spark, d):
    """All query vectors in groups of five sub-queries (the last may have fewer), each normalised alone, with equal parts of the weight."""
    content, asked = _vectors(spark, d)
    group = F.floor(F.col("query") / 500).alias("questions")
    parts = asked.groupBy(group).agg(F.count(F.lit(1)).alias("parts"))
    value = 1 - F.col("distance") / F.max("distance").over(Window.partitionBy("query"))
    scored = vector.nearest(content, asked).select(group, "unit", value.alias("v")).join(parts, "questions")
    return scored.groupBy("questions", "unit").agg(F.round(F.sum(F.col("v") / F.col("parts")), 6).alias("score"))


@query(
    """WITH sec AS (SELECT label, arg_min(embedding, vec_id) AS vector FROM embeddings GROUP BY 1),
s AS (SELECT q.vec_id AS query, sec.label, round(list_cosine_distance(vector::DOUBLE[], q.embedding::DOUBLE[]), 9) AS distance FROM sec JOIN embeddings q ON len(q.embedding) = len(vector) WHERE q.vec_id % 100 = 0),
n AS (SELECT query, label, CASE WHEN max(distance) OVER (PARTITION BY query) = 0 THEN 1 ELSE 1 - distance / max(distance) OVER (PARTITION BY query) END AS v FROM s)
SELECT n.query, e.vec_id AS unit, round(max(n.v), 6) AS score FROM embeddings e JOIN n USING (label) GROUP BY 1, 2"""
)
def section_spread(spark, d):
    """Sections (labels, with their first row's vector) by distance to every query vector, their normalised values spread to their units."""
    _, asked = _vectors(spark, d)
    e = table(spark, d, "embeddings")
    sections = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("section"))
    near = sections.join(small_side(asked), F.size("section") == F.size("vector"))
    near = near.select("query", "label", F.round(cosine_distance(F.col("section"), F.col("vector")), 9).alias("distance"))
    top = near.groupBy("query").agg(F.max("distance").alias("m"))
    value = F.when(F.col("m") == 0, 1.0).otherwise(1 - F.col("distance") / F.col("m"))
    scored = near.join(top, "query").select("query", "label", value.alias("v"))
    return e.join(scored, "label").groupBy("query", F.col("vec_id").alias("unit")).agg(F.round(F.max("v"), 6).alias("score"))


@query(
    """WITH q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS term FROM eval_items),
t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS tokens FROM documents),
n AS (SELECT count(*) AS n, avg(len(tokens)) AS m FROM t),
p AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(tokens) AS len, unnest(tokens) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT q.query_id, p.doc_id, sum(ln(1 + (n.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.len / n.m))) AS score
  FROM p JOIN q USING (term) JOIN f USING (term) CROSS JOIN n GROUP BY ALL)
SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s QUALIFY rank <= 20"""
)
def bm25(spark, d):
    """The 20 best documents of every benchmark text by Okapi BM25 over all documents."""
    asked = table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"), lexical.terms_of(F.col("text")).alias("terms"))
    return lexical.bm25(table(spark, d, "documents"), asked, "doc_id", "text").withColumn("score", F.round("score", 6))


@query(
    """WITH k AS (SELECT page_result_id, trim(regexp_replace(regexp_replace(unnest(coalesce(keywords, []) || coalesce(entities, [])), '[^A-Za-z0-9]+', ' ', 'g'), ' +', ' ', 'g')) AS t,
    generate_subscripts(coalesce(keywords, []) || coalesce(entities, []), 1) AS i FROM page_results),
u AS (SELECT page_result_id, arg_min(t, i) AS t, min(i) AS i FROM k WHERE t <> '' GROUP BY page_result_id, lower(t)),
r AS (SELECT *, row_number() OVER (PARTITION BY page_result_id ORDER BY i) AS n FROM u)
SELECT page_result_id, string_agg(CASE WHEN contains(t, ' ') THEN '"' || t || '"' ELSE t END, ' OR ' ORDER BY i) AS query_text FROM r WHERE n <= 6 GROUP BY 1"""
)
def bm25_query_build(spark, d):
    """The text query that each page's keywords and entities would make."""
    p = table(spark, d, "page_results")
    none = F.array().cast("array<string>")
    terms = F.concat(F.coalesce("keywords", none), F.coalesce("entities", none))
    return p.select("page_result_id", lexical.query_text(terms, F.lit("")).alias("query_text")).where("query_text <> ''")


_ANY = "len(list_filter(['ratio', 'CAP_TAL', 'deposit'], lambda q: len(list_filter(coalesce({0}, []), lambda k: k ILIKE '%' || q || '%')) > 0))"


@query(f"SELECT page_result_id, {_ANY.format('keywords')}::INT AS n_matched FROM page_results WHERE {_ANY.format('keywords')} > 0")
def kw_contains_any(spark, d):
    """R08"""
    return lexical.contains_any(table(spark, d, "page_results"), "keywords", ["ratio", "CAP_TAL", "deposit"], ["page_result_id"])


_ENT = _ANY.replace("['ratio', 'CAP_TAL', 'deposit']", "['dwick', 'tara', 'mossa']").format("entities")


@query(f"SELECT page_result_id, {_ENT}::INT AS n_matched FROM page_results WHERE {_ENT} > 0 ORDER BY n_matched DESC, page_result_id LIMIT 10")
def entity_contains_any(spark, d):
    """The feature is a list of ten."""
    return lexical.contains_any(table(spark, d, "page_results"), "entities", ["dwick", "tara", "mossa"], ["page_result_id"], 10)


@query("SELECT page_result_id FROM page_results WHERE list_has_all(keywords, ['stage 2 exposures', 'net stable funding ratio'])")
def kw_contains_all(spark, d):
    """R10"""
    return lexical.contains_all(table(spark, d, "page_results"), "keywords", ["stage 2 exposures", "net stable funding ratio"]).select("page_result_id")


_NORMAL = """h AS (SELECT query_id, strategy, coalesce(sub_query, 0) AS sub_query, content_unit_id, max(score) AS score, min(distance) AS distance
  FROM search_results WHERE query_id IS NOT NULL AND content_unit_id IS NOT NULL AND strategy IS NOT NULL GROUP BY ALL),
m AS (SELECT query_id, strategy, coalesce(sub_query, 0) AS sub_query, max(score) AS s, max(distance) AS d,
  count(*) OVER (PARTITION BY query_id, strategy) AS lists FROM search_results WHERE query_id IS NOT NULL AND content_unit_id IS NOT NULL AND strategy IS NOT NULL GROUP BY 1, 2, 3),
n AS (SELECT h.*, m.lists, CASE WHEN h.distance IS NOT NULL THEN CASE WHEN m.d = 0 THEN 1 ELSE 1 - h.distance / m.d END
  WHEN h.score IS NOT NULL THEN CASE WHEN m.s = 0 THEN 1 ELSE h.score / m.s END ELSE 1 END AS normalised
  FROM h JOIN m USING (query_id, strategy, sub_query)),
w(strategy, weight) AS (VALUES ('content_vector', 0.25::DOUBLE), ('hyde_vector', 0.2), ('subquery_vector', 0.15), ('keyword_vector', 0.1), ('section_summary', 0.1), ('bm25', 0.12), ('keyword_array', 0.07), ('entity_array', 0.01)),
parts AS (SELECT query_id, content_unit_id, strategy, sum(normalised / lists) AS part FROM n GROUP BY ALL),
f AS (SELECT p.query_id, p.content_unit_id, sum(coalesce(w.weight, 0) * p.part) AS score FROM parts p LEFT JOIN w USING (strategy) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, content_unit_id) AS position FROM f)"""


@query(f"WITH {_NORMAL} SELECT query_id, strategy, sub_query, content_unit_id, round(normalised, 6) AS normalised FROM n")
def normalize(spark, d):
    """Hits of all strategies, normalised in their lists."""
    return fusion.normalised_hits(table(spark, d, "search_results")).select("query_id", "strategy", "sub_query", "content_unit_id", F.round("normalised", 6).alias("normalised"))


@query(f"WITH {_NORMAL} SELECT query_id, content_unit_id, round(score, 6) AS score, position FROM r")
def fusion_rank(spark, d):
    """The flagship query, eight strategies fused by weight."""
    hits = table(spark, d, "search_results")
    hot = fusion.hot_queries(hits)
    return fusion.ranked(fusion.fused(hits, hot=hot), hot=hot).select("query_id", "content_unit_id", F.round("score", 6).alias("score"), "position")


@query(f"WITH {_NORMAL} SELECT query_id, position <= 10 AS forwarded, count(*) AS units FROM r GROUP BY ALL")
def candidate_cut(spark, d):
    """O09"""
    hits = table(spark, d, "search_results")
    hot = fusion.hot_queries(hits)
    r = fusion.ranked(fusion.fused(hits, hot=hot), hot=hot)
    return r.groupBy("query_id", (F.col("position") <= 10).alias("forwarded")).agg(F.count(F.lit(1)).alias("units"))


@query(f"WITH {_NORMAL} SELECT query_id, round(min(score), 4) AS score_min, round(max(score), 4) AS score_max, round(avg(score), 4) AS score_mean FROM f GROUP BY 1")
def score_summary(spark, d):
    """A09"""
    return fusion.score_summary(fusion.fused(table(spark, d, "search_results")))


@query(
    f"""WITH {_NORMAL}, o(strategy, o) AS (VALUES ('content_vector', 1), ('hyde_vector', 2), ('keyword_vector', 3), ('subquery_vector', 4), ('section_summary', 5), ('bm25', 6), ('keyword_array', 7), ('entity_array', 8)),
b AS (SELECT p.query_id, p.content_unit_id, p.strategy FROM parts p JOIN w USING (strategy) JOIN o USING (strategy)
  QUALIFY row_number() OVER (PARTITION BY p.query_id, p.content_unit_id ORDER BY round(w.weight * p.part, 9) DESC, o.o) = 1)
SELECT query_id, strategy, count(*) AS units FROM b GROUP BY ALL"""
)
def dominant_strategy(spark, d):
    """A10"""
    return fusion.dominant_strategies(fusion.fused(table(spark, d, "search_results")))


@query(
    """WITH o(strategy, o) AS (VALUES ('content_vector', 1), ('hyde_vector', 2), ('keyword_vector', 3), ('subquery_vector', 4), ('section_summary', 5), ('bm25', 6), ('keyword_array', 7), ('entity_array', 8))
SELECT query_id, content_unit_id, page_number, token_count, strategy FROM search_results JOIN o USING (strategy)
QUALIFY row_number() OVER (PARTITION BY query_id, content_unit_id ORDER BY o, page_number NULLS FIRST, token_count NULLS FIRST, strategy) = 1"""
)
def first_payload(spark, d):
    """A23"""
    return fusion.first_payload(table(spark, d, "search_results"), ["page_number", "token_count", "strategy"])


@query(
    f"""WITH {_NORMAL}, c AS (SELECT *, position % 3 <> 0 AS removed FROM r WHERE position <= 30),
k AS (SELECT *, count(*) OVER (PARTITION BY query_id) AS n, count(*) FILTER (NOT removed) OVER (PARTITION BY query_id) AS kept,
  row_number() OVER (PARTITION BY query_id, removed ORDER BY position) AS place FROM c)
SELECT query_id, content_unit_id, position, removed AS restored FROM k WHERE NOT removed OR (n >= 12 AND place <= 12 - kept)"""
)
def rerank_keep(spark, d):
    """A judge removed two of three candidates; the best come back up to the floor."""
    hits = table(spark, d, "search_results")
    c = fusion.ranked(fusion.fused(hits), k=30).select("query_id", "content_unit_id", "position")
    judged = F.explode(F.filter(F.sequence(F.lit(1), F.lit(30)), lambda p: p % 3 != 0)).alias("position")
    removed = hits.select("query_id").distinct().select("query_id", judged)
    return fusion.kept_by_judge(c, removed, 12).select("query_id", "content_unit_id", "position", "restored")


def _units(spark, d):
    return table(spark, d, "page_results").withColumn("content_unit_id", store.unit_id())


_UNITS = """u AS (SELECT *, coalesce(nullif(chunk_id, ''), page_number::VARCHAR) AS content_unit_id FROM page_results),
o AS (SELECT *, row_number() OVER (PARTITION BY document_version_id ORDER BY page_number NULLS FIRST,
  coalesce(try_cast(split_part(content_unit_id, '.', 1) AS INT), 0), coalesce(try_cast(nullif(split_part(content_unit_id, '.', 2), '') AS INT), 0),
  coalesce(try_cast(nullif(split_part(content_unit_id, '.', 3), '') AS INT), 0), content_unit_id NULLS FIRST) AS place FROM u)"""


@query(f"WITH {_UNITS} SELECT document_version_id, content_unit_id, place FROM o")
def reading_order(spark, d):
    """O02, O03, O04"""
    return expand.numbered(_units(spark, d)).select("document_version_id", "content_unit_id", "place")


@query(
    f"""WITH {_UNITS} SELECT t.document_version_id, t.content_unit_id AS trigger, o.content_unit_id, o.place FROM o t JOIN o
ON o.document_version_id = t.document_version_id AND o.place BETWEEN t.place - 4 AND t.place + 4"""
)
def neighbors(spark, d):
    """The neighbours of every unit."""
    u = _units(spark, d)
    return expand.neighbours(u, u).select("document_version_id", "trigger", "content_unit_id", "place")


_SECTIONS = f"""{_UNITS},
sec AS (SELECT document_version_id, section_id, sum(coalesce(token_count, 0)) AS tokens, CASE WHEN contains(section_id, '.') THEN split_part(section_id, '.', 1) ELSE '' END AS parent
  FROM u WHERE coalesce(section_id, '') <> '' GROUP BY 1, 2),
plan AS (SELECT u.document_version_id, u.content_unit_id, u.page_result_id, u.section_id, CASE WHEN s.parent <> '' THEN s.parent ELSE u.section_id END AS root,
  CASE WHEN r.tokens <= 6000 THEN 'full_section' WHEN s.parent <> '' AND s.tokens <= 3000 THEN 'subsection' ELSE 'neighbours' END AS strategy
  FROM u LEFT JOIN sec s ON s.document_version_id = u.document_version_id AND s.section_id = u.section_id
  LEFT JOIN sec r ON r.document_version_id = u.document_version_id AND r.section_id = CASE WHEN s.parent <> '' THEN s.parent ELSE u.section_id END)"""


def _planned(spark, d):
    u = _units(spark, d)
    sections = expand.section_sizes(u).select(
        "document_version_id", "section_id", F.col("section_tokens").alias("token_count"),
        F.when(F.contains("section_id", F.lit(".")), F.split("section_id", r"\.")[0]).otherwise("").alias("parent_section_id"),
    )
    return expand.expansion_strategies(u, sections)


@query(f"WITH {_SECTIONS} SELECT page_result_id, strategy FROM plan")
def expand_strategy(spark, d):
    """R16, J06"""
    return _planned(spark, d).select("page_result_id", "strategy")


_EXPANDED = f"""{_SECTIONS}, hit AS (SELECT *, 1.0::DOUBLE / (1 + coalesce(token_count, 0)) AS score FROM plan JOIN (SELECT page_result_id, token_count FROM page_results) USING (page_result_id)),
x AS (SELECT h.document_version_id, h.content_unit_id AS trigger, h.strategy, p.content_unit_id, h.score FROM hit h JOIN plan p ON p.document_version_id = h.document_version_id AND p.root = h.root WHERE h.strategy = 'full_section'
  UNION ALL SELECT h.document_version_id, h.content_unit_id, h.strategy, p.content_unit_id, h.score FROM hit h JOIN plan p ON p.document_version_id = h.document_version_id AND p.section_id = h.section_id WHERE h.strategy = 'subsection'
  UNION ALL SELECT h.document_version_id, h.content_unit_id, h.strategy, o.content_unit_id, h.score FROM hit h JOIN o t ON t.page_result_id = h.page_result_id
    JOIN o ON o.document_version_id = t.document_version_id AND o.place BETWEEN t.place - 4 AND t.place + 4 WHERE h.strategy = 'neighbours')"""


@query(f"WITH {_EXPANDED} SELECT document_version_id, trigger, strategy, content_unit_id, CASE WHEN trigger = content_unit_id THEN score ELSE 0 END AS score, trigger = content_unit_id AS is_original FROM x")
def expand_hits(spark, d):
    """Every unit as a hit, short ones first."""
    planned = _planned(spark, d)
    return expand.expanded(planned, planned.withColumn("score", 1.0 / (1 + F.coalesce("token_count", F.lit(0)))))


@query(f"WITH {_EXPANDED} SELECT document_version_id, content_unit_id, bool_or(trigger = content_unit_id) AS is_original, max(CASE WHEN trigger = content_unit_id THEN score ELSE 0 END) AS score FROM x GROUP BY 1, 2")
def dedup_prefer_original(spark, d):
    """R18, A12"""
    return expand.deduplicated(expand_hits(spark, d)).drop("triggers")


_FOUND = f"""{_NORMAL}, {_SECTIONS},
hit AS (SELECT s.query_id, p.*, f.score FROM (SELECT DISTINCT query_id, document_version_id, content_unit_id FROM search_results) s
  JOIN plan p ON p.document_version_id = s.document_version_id AND p.content_unit_id = s.content_unit_id JOIN f ON f.query_id = s.query_id AND f.content_unit_id = s.content_unit_id),
x AS (SELECT h.query_id, h.document_version_id, h.content_unit_id AS trigger, h.strategy, p.content_unit_id, h.score FROM hit h JOIN plan p ON p.document_version_id = h.document_version_id AND p.root = h.root WHERE h.strategy = 'full_section'
  UNION ALL SELECT h.query_id, h.document_version_id, h.content_unit_id, h.strategy, p.content_unit_id, h.score FROM hit h JOIN plan p ON p.document_version_id = h.document_version_id AND p.section_id = h.section_id WHERE h.strategy = 'subsection'
  UNION ALL SELECT h.query_id, h.document_version_id, h.content_unit_id, h.strategy, o.content_unit_id, h.score FROM hit h JOIN o t ON t.page_result_id = h.page_result_id
    JOIN o ON o.document_version_id = t.document_version_id AND o.place BETWEEN t.place - 4 AND t.place + 4 WHERE h.strategy = 'neighbours')"""


def _expanded_found(spark, d):
    """The expansions of the units that were hit, with the queries that hit them and their fused scores."""
    hits, planned, keys = table(spark, d, "search_results"), _planned(spark, d), ["document_version_id", "content_unit_id"]
    asked = hits.select("query_id", *keys).distinct().join(fusion.fused(hits).select("query_id", "content_unit_id", F.col("score").alias("_score")), ["query_id", "content_unit_id"])
    around = expand.expanded(planned, planned.join(hits.select(*keys).distinct(), keys, "left_semi").withColumn("score", F.lit(1.0)))
    rows = around.join(asked.withColumnRenamed("content_unit_id", "trigger"), ["document_version_id", "trigger"])
    return rows.withColumn("score", F.when(F.col("is_original"), F.col("_score")).otherwise(0.0)).drop("_score")


@query(
    f"""WITH {_FOUND} SELECT query_id, document_version_id, trigger, strategy, content_unit_id, round(CASE WHEN trigger = content_unit_id THEN score ELSE 0 END, 6) AS score,
trigger = content_unit_id AS is_original FROM x"""
)
def expand_search_hits(spark, d):
    """The hits of search_results with their fused scores, by query."""
    return _expanded_found(spark, d).withColumn("score", F.round("score", 6))


@query(
    f"""WITH {_FOUND} SELECT query_id, document_version_id, content_unit_id, bool_or(trigger = content_unit_id) AS is_original,
round(max(CASE WHEN trigger = content_unit_id THEN score ELSE 0 END), 6) AS score FROM x GROUP BY 1, 2, 3"""
)
def dedup_search_hits(spark, d):
    """By query."""
    rows = _expanded_found(spark, d).groupBy("query_id", "document_version_id", "content_unit_id")
    return rows.agg(F.bool_or("is_original").alias("is_original"), F.round(F.max("score"), 6).alias("score"))


@query("SELECT document_version_id, content_unit_id, count(*) AS n FROM (SELECT document_version_id, coalesce(nullif(chunk_id, ''), page_number::VARCHAR) AS content_unit_id FROM page_results) GROUP BY ALL HAVING count(*) > 1")
def duplicate_units(spark, d):
    """A11"""
    return _units(spark, d).groupBy("document_version_id", "content_unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(
    f"""WITH {_UNITS} SELECT document_version_id, page_number, section_id, arg_min(content_unit_id, place) AS content_unit_id FROM o GROUP BY ALL"""
)
def evidence_catalog(spark, d):
    """A13"""
    return expand.evidence_catalog(_units(spark, d))


@query(
    f"""WITH {_NORMAL}, {_UNITS}, t AS (SELECT document_version_id, coalesce(sum(token_count), 0) AS total FROM u GROUP BY 1),
hits AS (SELECT s.document_version_id, s.content_unit_id, max(f.score) AS score FROM (SELECT DISTINCT query_id, document_version_id, content_unit_id FROM search_results) s JOIN f USING (query_id, content_unit_id) GROUP BY 1, 2)
SELECT document_version_id, content_unit_id, 1.0::DOUBLE AS score FROM u JOIN t USING (document_version_id) WHERE total <= 20000
UNION ALL SELECT document_version_id, content_unit_id, round(score, 6) FROM hits WHERE document_version_id NOT IN (SELECT document_version_id FROM t WHERE total <= 20000)"""
)
def small_doc_bypass(spark, d):
    """Small documents whole, of the others the units that any query hit, with their best fused score."""
    hits = table(spark, d, "search_results")
    asked = hits.select("query_id", "document_version_id", "content_unit_id").where(F.col("document_version_id").isNotNull()).distinct()
    found = asked.join(fusion.fused(hits).select("query_id", "content_unit_id", "score"), ["query_id", "content_unit_id"]).groupBy("document_version_id", "content_unit_id").agg(F.max("score").alias("score"))
    return expand.small_or_searched(_units(spark, d), found, 20000).withColumn("score", F.round("score", 6))


@query(
    """WITH seen AS (SELECT DISTINCT document_version_id, content_unit_id FROM search_results WHERE strategy <> 'subquery_vector'),
h AS (SELECT document_version_id, content_unit_id, sub_query, distance FROM search_results s WHERE strategy = 'subquery_vector' AND distance IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.document_version_id = s.document_version_id AND seen.content_unit_id = s.content_unit_id))
SELECT document_version_id, content_unit_id, sub_query AS query_no, distance FROM h
QUALIFY row_number() OVER (PARTITION BY document_version_id, content_unit_id ORDER BY sub_query, distance) = 1"""
)
def unseen_hits(spark, d):
    """Sub-query hits that no other strategy had."""
    s = table(spark, d, "search_results")
    hits = s.where("strategy = 'subquery_vector' AND distance IS NOT NULL").select("document_version_id", "content_unit_id", F.col("sub_query").alias("query_no"), F.col("distance").alias("rank"))
    seen = s.where("strategy <> 'subquery_vector'").select("document_version_id", "content_unit_id")
    return expand.unseen_hits(hits, seen).withColumnRenamed("rank", "distance")
