"""Queries of the sources and sinks: what is written in an exchange format and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import stages, store
from folioflow.schemas import TABLES
from folioflow.session import scratch, table
from folioflow.sources import exchange, files
from folioflow.streaming import answers as streamed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


@query("SELECT page_result_id, document_version_id, page_number, raw_content, array_to_string(keywords, ';') AS keywords, token_count FROM page_results")
def dumped_tables(spark, d):
    """A dump as gzipped TSV and its load."""
    pages = table(spark, d, "page_results").select("page_result_id", "document_version_id", "page_number", "raw_content", "keywords", "token_count")
    folder = scratch(spark)
    exchange.dump_tables({"pages": pages}, folder)
    read = exchange.load_table(spark, folder, "pages", "page_result_id bigint, document_version_id bigint, page_number int, raw_content string, keywords array<string>, token_count int")
    return read.withColumn("keywords", F.array_join("keywords", ";"))


@query("SELECT document_version_id, page_result_id, raw_content FROM page_results")
def stored_artifacts(spark, d):
    """A stage's artifacts as JSON with checksums, read again; payloads call the text by its old name."""
    folder = scratch(spark)
    rows = table(spark, d, "page_results").select("document_version_id", "page_result_id", F.col("raw_content").alias("content"))
    exchange.write_artifacts(rows, "chunking", folder)
    return exchange.read_artifacts(spark, folder, "chunking", "document_version_id bigint, page_result_id bigint, raw_content string")


@query("SELECT filter_2 AS bank, filter_1 AS period, data_source AS source, count(*) AS n_versions FROM document_versions GROUP BY ALL")
def stored_traces(spark, d):
    """The units of a run as traces under its id, found by the list of runs and read again."""
    folder, trace = scratch(spark), exchange.trace_id("2026-01-01T10:00:00Z", "q")
    units = table(spark, d, "document_versions").groupBy(F.col("filter_2").alias("bank"), F.col("filter_1").alias("period"), F.col("data_source").alias("source")).agg(F.count(F.lit(1)).alias("n_versions"))
    exchange.write_traces(units, folder, trace)
    return exchange.read_trace(spark, folder, exchange.list_traces(spark, folder)[0]).select("bank", "period", "source", "n_versions")


@query("SELECT task || '-' || item_id AS name, text AS query FROM eval_items")
def stored_suite(spark, d):
    """The benchmark texts as a suite of test questions."""
    path = scratch(spark)
    items = table(spark, d, "eval_items").select(F.concat_ws("-", "task", "item_id").alias("name"), F.col("text").alias("query"))
    none = F.array().cast("array<struct<bank:string,period:string>>")
    exchange.write_suite(items.select("name", "query", none.alias("combos"), F.array().cast("array<string>").alias("sources"), F.lit("{}").alias("assertions")), path)
    return exchange.query_suite(spark, path).select("name", "query")


@query("SELECT finding_id, contains(lower(coalesce(finding, '')), 'higher') AS passed, segment FROM research_findings")
def stored_results(spark, d):
    """The results of a suite as JSON."""
    path = scratch(spark)
    f = table(spark, d, "research_findings")
    exchange.write_results(f.select("finding_id", F.contains(F.lower(F.coalesce("finding", F.lit(""))), F.lit("higher")).alias("passed"), "segment"), path)
    return spark.read.schema("finding_id bigint, passed boolean, segment string").json(path)


@query("SELECT document_version_id, page_result_id, CASE WHEN document_version_id % 2 = 0 THEN 'new' ELSE 'old' END AS state FROM page_results")
def replaced_versions(spark, d):
    """All rows of the versions that come again are replaced, twice, which is the same as once."""
    path = scratch(spark)
    pages = table(spark, d, "page_results").select("document_version_id", "page_result_id")
    store.replace_versions(spark, path, pages.withColumn("state", F.lit("old")).repartition("document_version_id"))
    again = pages.where("document_version_id % 2 = 0").withColumn("state", F.lit("new")).repartition("document_version_id")
    for _ in range(2):
        store.replace_versions(spark, path, again)
    return spark.read.schema("page_result_id bigint, state string, document_version_id bigint").parquet(path).select("document_version_id", "page_result_id", "state")


@query(
    """SELECT unnest(['document_catalog', 'document_versions', 'stage_checkpoints', 'document_metadata', 'document_sections', 'document_content']) AS table_name,
unnest([10, 13, 11, 13, 14, 18]) AS n_columns, 0::BIGINT AS n_rows"""
)
def created_tables(spark, d):
    """The six tables, made twice in a database of their own; one lacks a column at first."""
    name, path = "folioflow_" + scratch(spark)[-8:], scratch(spark)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    try:
        store.ensure_tables(spark, name)
        spark.sql(f"DROP TABLE {name}.document_versions")
        spark.createDataFrame([], TABLES["document_versions"]).drop("created_at").write.format("parquet").saveAsTable(f"{name}.document_versions")
        store.ensure_tables(spark, name)
        rows = [(t, len(spark.table(f"{name}.{t}").columns), spark.table(f"{name}.{t}").count()) for t in TABLES]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.createDataFrame(rows, "table_name string, n_columns int, n_rows bigint")


@query("SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN len(embedding) END AS size FROM embeddings")
def stored_vectors(spark, d):
    """An empty list becomes NULL."""
    e = table(spark, d, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding")).alias("v"))
    return e.select("vec_id", F.size(store.vector_or_null(F.col("v"))).alias("size")).withColumn("size", F.when(F.col("size") >= 0, F.col("size")).cast("bigint"))


@query(
    """SELECT data_source, filter_1, 'txt' AS filetype, false AS supported, 1 AS page_number, sha256(string_agg(filename, chr(10) ORDER BY filename)) AS digest
FROM (SELECT 'data_source=' || data_source AS data_source, 'filter_1=' || filter_1 AS filter_1, filename FROM document_versions WHERE data_source <> '' AND filter_1 <> '') GROUP BY 1, 2"""
)
def scanned_files(spark, d):
    """The names of each source and period as a text file in its folder, found by a walk and read by its type."""
    path = scratch(spark)
    v = table(spark, d, "document_versions").where("data_source <> '' AND filter_1 <> ''").select("data_source", "filter_1", F.col("filename").alias("value"))
    v.repartition("data_source", "filter_1").sortWithinPartitions("data_source", "filter_1", "value").write.partitionBy("data_source", "filter_1").text(path)
    root = path.removeprefix("file:")
    found = files.scan_files(spark, root).select("file_path", "data_source", "filter_1", "filetype", "supported")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    pages = files.extract_pages(content).where(F.col("error").isNull())
    joined = found.join(pages, "file_path")
    return joined.select("data_source", "filter_1", "filetype", "supported", "page_number", F.sha2(F.rtrim("raw_content", F.lit("\n")), 256).alias("digest"))


@query(
    """WITH l AS (SELECT document_version_id, finding_id, finding, row_number() OVER (PARTITION BY document_version_id ORDER BY finding_id) AS seq, finding_id = max(finding_id) OVER (PARTITION BY document_version_id) AS last, finding_id % 50 = 0 AS bad FROM research_findings)
SELECT document_version_id, seq, CASE WHEN bad THEN 'error' WHEN last THEN 'result' ELSE 'chunk' END AS event,
sha256('event: ' || CASE WHEN bad THEN 'error' WHEN last THEN 'result' ELSE 'chunk' END || chr(10) || 'data: ' || CASE WHEN bad THEN '{"message":"failed"}' ELSE to_json(struct_pack(text := coalesce(finding, '')))::VARCHAR END || chr(10) || chr(10)) AS digest
FROM l WHERE coalesce(finding, '') <> '' OR last OR bad"""
)
def answer_events(spark, d):
    """Answers as server-sent events, a finding a chunk."""
    from pyspark.sql import Window

    w = Window.partitionBy("document_version_id")
    f = table(spark, d, "research_findings").select(
        "document_version_id", F.row_number().over(w.orderBy("finding_id")).alias("seq"), F.col("finding").alias("text"), (F.col("finding_id") == F.max("finding_id").over(w)).alias("is_last"),
        F.when(F.col("finding_id") % 50 == 0, "failed").alias("error"),
    )
    return streamed.events(f, "document_version_id").withColumn("digest", F.sha2("data", 256)).drop("data")


@query("SELECT page_result_id, document_version_id, coalesce(raw_content, '') AS body FROM page_results")
def staged_pages(spark, d):
    """Two stages run with states and artifacts; the second fails at first and is taken up."""
    source = table(spark, d, "page_results").select("page_result_id", "document_version_id", "raw_content")
    folder, failed = scratch(spark), []

    def clean(rows: DataFrame) -> DataFrame:
        return rows.withColumn("raw_content", F.coalesce("raw_content", F.lit("")))

    def rename(rows: DataFrame) -> DataFrame:
        if not failed:
            failed.append(True)
            raise RuntimeError("executor lost")
        return rows.withColumnRenamed("raw_content", "body")

    run = stages.StageRun(spark, folder, [("clean", clean), ("rename", rename)], {"clean": "c1", "rename": "r1"})
    try:
        run.run(source)
    except RuntimeError:
        pass
    return run.run(source)
