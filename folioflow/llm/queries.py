"""Queries of this subpackage's operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.llm import encoding, leakage, packing, ranking, splitting
from folioflow.session import table


def _ranking(spark: SparkSession, sf_dir: str, top: int | None = None) -> DataFrame:
    hits = table(spark, sf_dir, "search_results")
    return ranking.fused_ranking(hits, "query_id", "strategy", "content_unit_id", ranking.directed_value(F.col("score"), F.col("distance")), top)


def p2_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranking(spark, sf_dir).withColumn("projection", F.round("projection", 6) + 0.0)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranking(spark, sf_dir, 3).select("query_id", "content_unit_id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf_dir, "page_results"), "page_result_id", "raw_content", "chunk_header")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "page_results")
    # page_result_id is unique and every page that is split has a piece 0
    pieces = splitting.split_oversized(pages, "page_result_id", "raw_content", "chunk_header", with_text=False)
    return pieces.where("piece_no = 0").select("page_result_id")


def p4_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every page that is split: its tokens, all of which stand in a piece, and how many pieces are over the limit or do not overlap by 128 tokens."""
    pieces = splitting.split_oversized(table(spark, sf_dir, "page_results"), "page_result_id", "raw_content", "chunk_header", with_text=False)
    own = Window.partitionBy("page_result_id").orderBy("piece_no")
    steps = pieces.withColumn("_next", F.lead("first_token").over(own))
    ends = F.col("first_token") + F.col("n_tokens")
    return steps.groupBy("page_result_id").agg(
        (F.max(ends) + F.max("header_tokens")).cast("bigint").alias("n_tokens"),
        F.min("first_token").cast("bigint").alias("first"),
        F.count_if(F.col("n_tokens") + F.col("header_tokens") > splitting.LIMIT).alias("n_over"),
        F.count_if(F.col("_next").isNotNull() & (ends - F.col("_next") != splitting.OVERLAP)).alias("n_apart"),
    )


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number of its pieces: one if it fits a container, none lost; and how many of its containers are over the capacity or other than their fill says."""
    rows = p6_containers(spark, sf_dir)
    used = rows.groupBy("container_id").agg(F.sum("n_tokens").alias("_used"))
    joined = rows.join(used.where(F.col("container_id").isNotNull()), "container_id", "left")
    wrong = F.coalesce((F.col("_used") > packing.CAPACITY) | (F.col("_used") != F.col("container_fill")), F.lit(False))
    by_document = joined.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.count_if(wrong).alias("n_wrong"), F.sum("n_tokens").alias("_n"), F.countDistinct("container_id").alias("_boxes"))
    split = (F.col("pieces") > 1) & (F.col("_n") <= packing.CAPACITY)
    return by_document.select("doc_id", "n_wrong", split.alias("split_for_nothing"), (F.col("_boxes") == 0).alias("is_empty"))


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks(spark, sf_dir).select("doc_id", "item_id")


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.restore_encoding(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.restore_encoding(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "restored_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (p2_found, p2_ranking, p4_found, p4_pieces, p4_coverage, p6_containers, p6_fill, p7_found, p7_leaks, p8_found, p8_restored)
    }


_P2_RANKS = """hits AS (
  SELECT query_id, strategy, content_unit_id, max(coalesce(score, -distance)) AS v
  FROM search_results WHERE coalesce(score, -distance) IS NOT NULL AND query_id IS NOT NULL AND strategy IS NOT NULL AND content_unit_id IS NOT NULL
  GROUP BY 1, 2, 3),
units AS (SELECT DISTINCT query_id, content_unit_id FROM hits),
cells AS (
  SELECT u.query_id, u.content_unit_id, s.strategy, h.v
  FROM units u JOIN (SELECT DISTINCT query_id, strategy FROM hits) s USING (query_id)
  LEFT JOIN hits h ON h.query_id = u.query_id AND h.content_unit_id = u.content_unit_id AND h.strategy = s.strategy),
ranks AS (
  SELECT *, rank() OVER (PARTITION BY query_id, strategy ORDER BY v NULLS FIRST)
    + (count(*) OVER (PARTITION BY query_id, strategy, v) - 1) / 2.0 AS r,
    count(*) OVER (PARTITION BY query_id, strategy) AS n
  FROM cells)"""

P2_FOUND = f"""
WITH {_P2_RANKS},
sums AS (SELECT query_id, content_unit_id, sum((r - 0.5) / n) AS total FROM ranks GROUP BY 1, 2)
SELECT query_id, content_unit_id FROM sums
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(total, 9) DESC, content_unit_id) <= 3"""

# the first principal component by power iteration
P2_RANKING = f"""
WITH RECURSIVE {_P2_RANKS},
s AS (SELECT strategy, row_number() OVER (ORDER BY strategy) AS k FROM (SELECT DISTINCT strategy FROM hits)),
x AS (SELECT u.query_id, u.content_unit_id, s.k, coalesce((r.r - 0.5) / r.n, 0.5)::DOUBLE AS x
  FROM units u CROSS JOIN s LEFT JOIN ranks r ON r.query_id = u.query_id AND r.content_unit_id = u.content_unit_id AND r.strategy = s.strategy),
m AS (SELECT k, avg(x) AS mu, stddev_pop(x) AS sd FROM x GROUP BY 1),
z AS (SELECT query_id, content_unit_id, x.k, (x - mu) / sd AS z FROM x JOIN m USING (k)),
c AS (SELECT a.k AS i, b.k AS j, avg(a.z * b.z) AS c FROM z a JOIN z b ON a.query_id = b.query_id AND a.content_unit_id = b.content_unit_id GROUP BY 1, 2),
rows_of AS (SELECT list(l ORDER BY i) AS c FROM (SELECT i, list(c ORDER BY j) AS l FROM c GROUP BY 1)),
it AS (SELECT 0 AS n, (SELECT list(1.0::DOUBLE) FROM s) AS v
  UNION ALL SELECT n + 1, list_transform(list_transform(c, lambda r: list_dot_product(r, v)), lambda y: y / sqrt(list_dot_product(list_transform(c, lambda r: list_dot_product(r, v)), list_transform(c, lambda r: list_dot_product(r, v))))) FROM it, rows_of WHERE n < 300),
loads AS (SELECT generate_subscripts(v, 1) AS k, abs(unnest(v)) AS load FROM it WHERE n = 300),
p AS (SELECT query_id, content_unit_id, sum(z * load) AS projection FROM z JOIN loads USING (k) GROUP BY 1, 2)
SELECT query_id, content_unit_id, round(projection, 6) + 0.0 AS projection, row_number() OVER (PARTITION BY query_id ORDER BY round(projection, 9) DESC, content_unit_id) AS position FROM p"""

P4_FOUND = r"""
SELECT page_result_id FROM page_results
WHERE len(regexp_extract_all(coalesce(chunk_header, ''), '[^ \t\r\n]+')) + len(regexp_extract_all(coalesce(raw_content, ''), '[^ \t\r\n]+')) > 8192"""


_TOKENS = r"len(regexp_extract_all(coalesce({0}, ''), '[^ \t\r\n]+'))"
P4_COVERAGE = f"""
SELECT page_result_id, ({_TOKENS.format('chunk_header')} + {_TOKENS.format('raw_content')})::BIGINT AS n_tokens, 0::BIGINT AS first, 0::BIGINT AS n_over, 0::BIGINT AS n_apart
FROM page_results WHERE {_TOKENS.format('chunk_header')} + {_TOKENS.format('raw_content')} > 8192"""

P6_FILL = "SELECT doc_id, 0::BIGINT AS n_wrong, false AS split_for_nothing, coalesce(text, '') = '' AS is_empty FROM documents"


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p2_ranking": P2_RANKING, "p4_found": P4_FOUND, "p4_coverage": P4_COVERAGE, "p6_fill": P6_FILL}
