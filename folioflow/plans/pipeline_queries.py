"""Queries of the general training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import incremental, snapshots, units
from folioflow.session import table


def p1_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("document_catalog", "document_versions", "stage_checkpoints", "stage_signatures")
    return incremental.pending_files(*[table(spark, sf_dir, n) for n in names])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_pending(spark, sf_dir).select("file_path", "first_stage")


def p3_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.catalog_changes(table(spark, sf_dir, "document_catalog")).withColumn("changed_fields", F.array_join("changed_fields", ","))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.catalog_changes(table(spark, sf_dir, "document_catalog")).select("snapshot_id", "file_path", "change")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.common_units(table(spark, sf_dir, "research_findings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_pending, p3_found, p3_changes, p5_found)}


_CLEAN = r"""
  SELECT snapshot_id, delivered_at, lower(trim(filetype)) AS filetype, file_size, date_last_modified,
    nfc_normalize(regexp_replace(trim(file_path, E' \t\r\n'), '[\\/]+', '/', 'g')) AS file_path,
    nullif(regexp_extract(lower(trim(file_hash)), '([0-9a-f]{64})$', 1), '') AS file_hash
  FROM document_catalog"""

_LATEST = f"""
clean AS ({_CLEAN}),
files AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY snapshot_id, file_path
    ORDER BY delivered_at DESC, file_hash DESC NULLS LAST, file_size DESC NULLS LAST, date_last_modified DESC NULLS LAST, filetype DESC NULLS LAST) = 1)"""

P1 = f"""
WITH {_LATEST},
newest AS (
  SELECT * FROM files WHERE snapshot_id = (SELECT max(snapshot_id) FROM document_catalog) AND filetype IN ('pdf', 'docx', 'pptx', 'xlsx')),
versioned AS (
  SELECT n.file_path, max(v.id) AS document_version_id
  FROM newest n LEFT JOIN document_versions v ON v.file_path = n.file_path AND (v.file_hash = n.file_hash
    OR (n.file_hash IS NULL AND v.file_size = n.file_size AND v.date_last_modified = n.date_last_modified))
  GROUP BY 1),
last AS (
  SELECT * FROM stage_checkpoints
  QUALIFY row_number() OVER (PARTITION BY document_version_id, stage_name
    ORDER BY updated_at DESC NULLS LAST, completed_at DESC NULLS LAST, started_at DESC NULLS LAST, created_at DESC NULLS LAST,
      status DESC NULLS LAST, stage_signature DESC NULLS LAST) = 1),
done AS (
  SELECT l.document_version_id, l.stage_name FROM last l JOIN stage_signatures s USING (stage_name, stage_signature)
  WHERE lower(trim(l.status, E' \t\r\n')) = 'succeeded'),
due AS (
  SELECT v.file_path, v.document_version_id, s.stage_order, s.stage_name FROM versioned v CROSS JOIN stage_signatures s
  WHERE v.document_version_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM done d WHERE d.document_version_id = v.document_version_id AND d.stage_name = s.stage_name))
SELECT $columns FROM (
  SELECT file_path, document_version_id, arg_min(stage_name, stage_order) AS first_stage FROM due GROUP BY 1, 2
  UNION ALL SELECT file_path, NULL, 'extraction' FROM versioned WHERE document_version_id IS NULL)"""

P3 = f"""
WITH {_LATEST},
numbers AS (SELECT snapshot_id, lag(snapshot_id) OVER (ORDER BY snapshot_id) AS prior FROM (SELECT DISTINCT snapshot_id FROM document_catalog)),
pairs AS (
  SELECT n.snapshot_id, coalesce(a.file_path, b.file_path) AS file_path, a.file_path IS NULL AS gone, b.file_path IS NULL AS fresh,
    CASE WHEN a.file_hash IS NULL OR b.file_hash IS NULL
      THEN a.file_size IS DISTINCT FROM b.file_size OR a.date_last_modified IS DISTINCT FROM b.date_last_modified
      ELSE a.file_hash <> b.file_hash END AS differs,
    concat_ws(',', CASE WHEN a.date_last_modified IS DISTINCT FROM b.date_last_modified THEN 'date_last_modified' END, CASE WHEN a.file_hash IS DISTINCT FROM b.file_hash THEN 'file_hash' END,
      CASE WHEN a.file_size IS DISTINCT FROM b.file_size THEN 'file_size' END) AS fields
  FROM numbers n
  JOIN (SELECT snapshot_id AS s, file_path AS p FROM files UNION SELECT n2.snapshot_id, f.file_path FROM files f JOIN numbers n2 ON n2.prior = f.snapshot_id) k
    ON k.s = n.snapshot_id
  LEFT JOIN files a ON a.snapshot_id = n.snapshot_id AND a.file_path = k.p
  LEFT JOIN files b ON b.snapshot_id = n.prior AND b.file_path = k.p
  WHERE n.prior IS NOT NULL)
SELECT snapshot_id, file_path, CASE WHEN fresh THEN 'added' WHEN gone THEN 'removed' ELSE 'changed' END AS change$more
FROM pairs WHERE gone OR fresh OR differs"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1.replace("$columns", "file_path, first_stage"), "p1_pending": P1.replace("$columns", "file_path, document_version_id, first_stage"), "p3_found": P3.replace("$more", ""), "p3_changes": P3.replace("$more", ", CASE WHEN NOT fresh AND NOT gone THEN fields END AS changed_fields")}
