"""All queries outside the optional subpackages, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioflow.plans import answer_queries, content_queries, detail_queries, exchange_queries, pipeline_queries, run_queries, search_queries, store_queries

GROUPS = (store_queries, search_queries, content_queries, answer_queries, detail_queries, run_queries, exchange_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return pipeline_queries.queries() | {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return pipeline_queries.oracle_sql() | {name: sql for group in GROUPS for name, sql in group.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_queries.fusion_rank(spark, sf_dir)
