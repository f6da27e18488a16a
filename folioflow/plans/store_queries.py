"""Queries of the store, discovery and planning operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import planning, snapshots, store
from folioflow.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_FILES = """
raw AS (SELECT snapshot_id, delivered_at, file_path, file_size, date_last_modified, nullif(file_hash, '') AS file_hash FROM document_catalog),
files AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY snapshot_id, file_path
  ORDER BY delivered_at DESC, file_hash DESC NULLS LAST, file_size DESC NULLS LAST, date_last_modified DESC NULLS LAST) = 1)"""


def _files(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "document_catalog").withColumn("file_hash", F.nullif("file_hash", F.lit("")))
    return snapshots.latest_rows(raw, ["snapshot_id", "file_path"], ["delivered_at"], ["delivered_at", "file_hash", "file_size", "date_last_modified"])


@query(
    """SELECT file_path, split_part(ltrim(file_path, '/'), '/', 2) AS c_source, split_part(ltrim(file_path, '/'), '/', 3) AS c_1,
  split_part(ltrim(file_path, '/'), '/', 4) AS c_2,
  CASE WHEN len(string_split(ltrim(file_path, '/'), '/')) > 5
    THEN array_to_string(list_slice(string_split(ltrim(file_path, '/'), '/'), 5, len(string_split(ltrim(file_path, '/'), '/')) - 1), '/') ELSE '' END AS c_3
FROM document_versions"""
)
def source_context(spark, d):
    """Context fields from the path."""
    c = planning.path_context(F.regexp_replace("file_path", "^/data/", ""))
    return table(spark, d, "document_versions").withColumn("c", c).select(
        "file_path", F.col("c.data_source").alias("c_source"), F.col("c.filter_1").alias("c_1"), F.col("c.filter_2").alias("c_2"), F.col("c.filter_3").alias("c_3")
    )


@query("SELECT id, coalesce(data_source, '') AS data_source, coalesce(filter_1, '') AS filter_1, coalesce(filter_2, '') AS filter_2, coalesce(filter_3, '') AS filter_3 FROM document_versions")
def context_fallback(spark, d):
    """Blank context is derived from the path again; blanking every field must give the stored ones."""
    v = table(spark, d, "document_versions").select("id", "file_path", *[F.lit(None).cast("string").alias(c) for c in ("data_source", "filter_1", "filter_2", "filter_3")])
    return planning.with_context(v, "/data").select("id", "data_source", "filter_1", "filter_2", "filter_3")


@query("SELECT id, file_path, file_hash, created_at FROM document_versions WHERE is_current")
def current_versions(spark, d):
    """S06"""
    return table(spark, d, "document_versions").where("is_current").select("id", "file_path", "file_hash", "created_at")


@query(
    """SELECT id, filename FROM document_versions WHERE regexp_matches(file_path, '^.*\\.xlsx$') OR regexp_matches(filename, '^capital_notes.*$')"""
)
def selected_files(spark, d):
    """F01"""
    return table(spark, d, "document_versions").where(planning.selected(globs=["*.xlsx", "capital_notes*"])).select("id", "filename")


@query(
    """WITH combos AS (SELECT DISTINCT f.bank, v.filter_1 AS period FROM research_findings f JOIN document_versions v ON v.id = f.document_version_id WHERE f.bank <> '')
SELECT c.bank, c.period, v.id AS document_version_id, v.data_source, v.filename FROM combos c
JOIN document_versions v ON v.filter_2 = c.bank AND v.filter_1 = c.period AND v.is_current"""
)
def research_units(spark, d):
    """(bank, period) combinations joined to the current versions that answer them."""
    v = table(spark, d, "document_versions")
    f = table(spark, d, "research_findings").where("bank <> ''").select("bank", "document_version_id")
    combos = f.join(v.select(F.col("id").alias("document_version_id"), F.col("filter_1").alias("period")), "document_version_id").select("bank", "period").distinct()
    units = v.where("is_current").select(F.col("filter_2").alias("bank"), F.col("filter_1").alias("period"), F.col("id").alias("document_version_id"), "data_source", "filename")
    return combos.join(units, ["bank", "period"])


@query(
    f"""WITH {_FILES}, a AS (SELECT * FROM files WHERE snapshot_id = (SELECT max(snapshot_id) FROM raw)),
b AS (SELECT * FROM files WHERE snapshot_id = (SELECT min(snapshot_id) FROM raw))
SELECT coalesce(a.file_path, b.file_path) AS file_path, CASE WHEN b.file_path IS NULL THEN 'new' WHEN a.file_path IS NULL THEN 'deleted'
  WHEN a.file_size IS DISTINCT FROM b.file_size THEN 'modified' WHEN a.date_last_modified IS NOT DISTINCT FROM b.date_last_modified THEN 'unchanged'
  WHEN a.file_hash = b.file_hash THEN 'unchanged' ELSE 'modified' END AS status
FROM a FULL JOIN b ON a.file_path = b.file_path"""
)
def catalog_diff(spark, d):
    """Newest snapshot against the first."""
    files = _files(spark, d)
    low, high = table(spark, d, "document_catalog").agg(F.min("snapshot_id"), F.max("snapshot_id")).head()
    return planning.catalog_diff(files.where(F.col("snapshot_id") == high), files.where(F.col("snapshot_id") == low))


@query(
    f"""WITH {_FILES}, a AS (SELECT * FROM files WHERE snapshot_id = (SELECT max(snapshot_id) FROM raw)),
b AS (SELECT * FROM files WHERE snapshot_id = (SELECT min(snapshot_id) FROM raw))
SELECT a.file_path FROM a JOIN b USING (file_path) WHERE a.file_size = b.file_size AND a.date_last_modified <> b.date_last_modified"""
)
def digest_needed(spark, d):
    """Files that the lazy second pass has to read."""
    files = _files(spark, d)
    low, high = table(spark, d, "document_catalog").agg(F.min("snapshot_id"), F.max("snapshot_id")).head()
    return planning.needs_digest(files.where(F.col("snapshot_id") == high), files.where(F.col("snapshot_id") == low)).select("file_path")


@query(
    """SELECT file_path, file_hash, file_size, date_last_modified, delivered_at FROM document_catalog
QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY delivered_at DESC, file_hash DESC NULLS LAST, file_size DESC NULLS LAST, date_last_modified DESC NULLS LAST) = 1"""
)
def upsert_latest(spark, d):
    """The catalog after all deliveries were merged into it."""
    c = table(spark, d, "document_catalog").select("file_path", "file_hash", "file_size", "date_last_modified", "delivered_at", "snapshot_id")
    first = c.agg(F.min("snapshot_id")).head()[0]
    return store.merge_latest(c.where(F.col("snapshot_id") == first).drop("snapshot_id"), c.where(F.col("snapshot_id") > first).drop("snapshot_id"), ["file_path"], "delivered_at")


@query(
    """WITH seen AS (SELECT file_path, file_hash, max(delivered_at) AS delivered_at FROM document_catalog WHERE file_hash <> '' GROUP BY 1, 2)
SELECT file_path, file_hash, delivered_at, row_number() OVER (PARTITION BY file_path ORDER BY delivered_at DESC, file_hash DESC) = 1 AS is_current FROM seen"""
)
def scd2_current(spark, d):
    """Versions registered from all deliveries, the last one current."""
    c = table(spark, d, "document_catalog").where("file_hash <> ''").select("file_path", "file_hash", "delivered_at")
    return store.versions_of(c, "file_path", "file_hash", ["delivered_at"], []).select("file_path", "file_hash", "delivered_at", "is_current")


@query(
    """WITH gone AS (SELECT file_path FROM document_catalog WHERE snapshot_id = (SELECT min(snapshot_id) FROM document_catalog)
  EXCEPT SELECT file_path FROM document_catalog WHERE snapshot_id = (SELECT max(snapshot_id) FROM document_catalog))
SELECT id, file_path, is_current AND file_path NOT IN (SELECT file_path FROM gone WHERE file_path IS NOT NULL) AS is_current FROM document_versions"""
)
def remove_deleted(spark, d):
    """Versions of files that left the store are no longer current."""
    c = table(spark, d, "document_catalog")
    low, high = c.agg(F.min("snapshot_id"), F.max("snapshot_id")).head()
    gone = store.without_keys(c.where(F.col("snapshot_id") == low).select("file_path"), c.where(F.col("snapshot_id") == high).select("file_path"), "file_path")
    return store.delete_files(c, table(spark, d, "document_versions"), gone)[1].select("id", "file_path", "is_current")


@query(
    """WITH gone AS (SELECT id FROM document_versions QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY is_current DESC, created_at DESC, id DESC) > 2)
SELECT 'document_versions' AS table_name, count(*) AS n_rows FROM document_versions WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'stage_checkpoints', count(*) FROM stage_checkpoints WHERE document_version_id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'page_results', count(*) FROM page_results WHERE document_version_id NOT IN (SELECT id FROM gone)"""
)
def cascade_delete(spark, d):
    """Rows left in each table after the prunable versions went."""
    t = {n: table(spark, d, n) for n in ("document_versions", "stage_checkpoints", "page_results")}
    gone = store.prunable_versions(t["document_versions"]).select(F.col("id").alias("document_version_id"))
    return store.table_counts(store.delete_versions(t, gone))


@query("SELECT document_version_id, stage_name, status, updated_at FROM stage_checkpoints WHERE stage_name IN ('extraction', 'tokenization', 'classification')")
def cleared_stages(spark, d):
    """What stays when the stages from chunking on are cleared."""
    return store.cleared_from(table(spark, d, "stage_checkpoints"), "chunking").select("document_version_id", "stage_name", "status", "updated_at")


_LAST = """last AS (SELECT document_version_id, stage_name, lower(trim(status)) AS status, stage_signature, updated_at,
  CASE WHEN lower(trim(status)) = 'failed' THEN '' ELSE artifact_path END AS artifact_path,
  CASE WHEN lower(trim(status)) = 'failed' THEN '' ELSE artifact_checksum END AS artifact_checksum
  FROM stage_checkpoints QUALIFY row_number() OVER (PARTITION BY document_version_id, stage_name ORDER BY updated_at DESC NULLS LAST,
    completed_at DESC NULLS LAST, started_at DESC NULLS LAST, created_at DESC NULLS LAST, status DESC NULLS LAST, stage_signature DESC NULLS LAST,
    artifact_path DESC NULLS LAST, artifact_checksum DESC NULLS LAST) = 1)"""


@query(f"WITH {_LAST} SELECT document_version_id, stage_name, status, stage_signature, artifact_path, artifact_checksum FROM last")
def latest_states(spark, d):
    """D08"""
    return store.latest_states(table(spark, d, "stage_checkpoints")).select("document_version_id", "stage_name", "status", "stage_signature", "artifact_path", "artifact_checksum")


@query(f"WITH {_LAST} SELECT l.document_version_id, v.file_path, l.stage_name, l.status FROM last l JOIN document_versions v ON v.id = l.document_version_id WHERE v.is_current")
def current_checkpoints(spark, d):
    """J01"""
    v = table(spark, d, "document_versions").where("is_current").select(F.col("id").alias("document_version_id"), "file_path")
    return store.latest_states(table(spark, d, "stage_checkpoints")).join(v, "document_version_id").select("document_version_id", "file_path", "stage_name", "status")


@query(
    f"""WITH {_LAST} SELECT document_version_id, to_json(map_from_entries(list((stage_name, status) ORDER BY stage_name))) AS statuses FROM last
WHERE stage_name IS NOT NULL AND status IS NOT NULL GROUP BY 1"""
)
def checkpoint_maps(spark, d):
    """J16"""
    c = table(spark, d, "stage_checkpoints")
    maps = planning.checkpoints_by_version(c)
    known = F.map_filter("statuses", lambda k, v: v.isNotNull())
    return maps.where(F.size(known) > 0).select("document_version_id", F.to_json(known).alias("statuses"))


@query(
    """SELECT id, file_path, row_number() OVER (PARTITION BY file_path ORDER BY is_current DESC NULLS LAST, created_at DESC NULLS LAST, id DESC) AS version_rank
FROM document_versions QUALIFY version_rank > 2"""
)
def prune_versions(spark, d):
    """W01, T06"""
    return store.prunable_versions(table(spark, d, "document_versions")).select("id", "file_path", "version_rank")


@query(
    """WITH gone AS (SELECT id, file_path FROM document_versions QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY is_current DESC, created_at DESC, id DESC) > 1)
SELECT g.id, g.file_path, coalesce(array_to_string(list_sort(list(DISTINCT c.artifact_path) FILTER (c.artifact_path IS NOT NULL)), ';'), '') AS artifact_paths
FROM gone g LEFT JOIN stage_checkpoints c ON c.document_version_id = g.id AND c.artifact_path <> '' GROUP BY 1, 2"""
)
def prunable_artifacts(spark, d):
    """All old versions and the artifacts to remove with them."""
    out = store.prunable_artifacts(table(spark, d, "document_versions"), table(spark, d, "stage_checkpoints"), 0)
    return out.withColumn("artifact_paths", F.array_join("artifact_paths", ";"))


@query("SELECT file_path, max(id) AS id FROM document_versions WHERE is_current GROUP BY 1")
def current_version_ids(spark, d):
    """O07"""
    return table(spark, d, "document_versions").where("is_current").groupBy("file_path").agg(F.max("id").alias("id"))


_USABLE = f"""{_LAST}, ok AS (SELECT l.document_version_id, s.stage_order FROM last l JOIN stage_signatures s ON s.stage_name = l.stage_name
  WHERE l.status = 'succeeded' AND l.stage_signature = s.stage_signature AND l.artifact_path <> '' AND l.artifact_checksum <> ''),
run AS (SELECT v.id AS document_version_id, (SELECT count(*) FROM stage_signatures s WHERE s.stage_order < coalesce((
    SELECT min(s2.stage_order) FROM stage_signatures s2 WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.document_version_id = v.id AND ok.stage_order = s2.stage_order)), 12)) AS completed
  FROM document_versions v WHERE v.is_current)"""


@query(
    f"""WITH {_USABLE} SELECT r.document_version_id, r.completed::INT AS completed, s.stage_name AS start_stage,
  CASE WHEN r.completed >= 11 THEN 'skip' WHEN r.completed = 0 THEN 'full' ELSE 'resume' END AS action
FROM run r LEFT JOIN stage_signatures s ON s.stage_order = r.completed + 1"""
)
def resume_plan(spark, d):
    """T01, T02, W11, J05"""
    return planning.resume_plans(table(spark, d, "document_versions"), table(spark, d, "stage_checkpoints"), table(spark, d, "stage_signatures"))


@query(
    """SELECT document_version_id, count(*) AS units, count(*) FILTER (len(coalesce(keywords, [])) > 0) AS with_keywords,
  count(*) FILTER (coalesce(section_id, '') <> '') AS with_section, count(*) FILTER (coalesce(token_count, 0) > 0) AS with_tokens
FROM page_results GROUP BY 1"""
)
def completeness(spark, d):
    """A02"""
    return store.completeness(table(spark, d, "page_results"))


@query("SELECT document_version_id, coalesce(sum(token_count), 0)::BIGINT AS total_tokens FROM page_results GROUP BY 1")
def document_tokens(spark, d):
    """A01"""
    return table(spark, d, "page_results").groupBy("document_version_id").agg(F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"))


@query(
    """SELECT 'bank' AS facet, filter_2 AS value FROM document_versions WHERE is_current UNION SELECT 'period', filter_1 FROM document_versions WHERE is_current
UNION SELECT 'data_source', data_source FROM document_versions WHERE is_current"""
)
def facets(spark, d):
    """The three facets in one pass."""
    v = table(spark, d, "document_versions").where("is_current")
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), F.col(c).alias("value")) for n, c in (("bank", "filter_2"), ("period", "filter_1"), ("data_source", "data_source"))])
    return v.select(F.explode(pairs).alias("p")).select("p.*").distinct()


@query(
    """SELECT document_version_id, coalesce(nullif(chunk_id, ''), page_number::VARCHAR) AS content_unit_id, coalesce(section_id, '') AS section_id,
  len(coalesce(keywords, []))::INT AS n_keywords, len(regexp_extract_all(lower(coalesce(raw_content, '')), '[a-z0-9]+'))::INT AS n_tokens, coalesce(token_count, 0) AS token_count
FROM page_results"""
)
def content_rows(spark, d):
    """D10"""
    return store.content_rows(table(spark, d, "page_results")).select(
        "document_version_id", "content_unit_id", "section_id", F.size("keywords").alias("n_keywords"), F.size("tokens").alias("n_tokens"), "token_count"
    )


@query("SELECT id, sha256(file_path || chr(0) || file_hash) AS artifact_key FROM document_versions")
def content_hash(spark, d):
    """The name under which a version's artifacts are kept."""
    return table(spark, d, "document_versions").select("id", F.sha2(F.concat_ws("\u0000", "file_path", "file_hash"), 256).alias("artifact_key"))
