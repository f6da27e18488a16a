"""The store's writes as set operations on Parquet tables: merge, versions, deletes, replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.operators.snapshots import latest_rows
from folioflow.schemas import STAGES, TABLES, struct


def ensure_tables(spark: SparkSession, database: str = "default") -> None:
    """Create the tables that are missing; columns that a table lacks are added, NULL in old rows."""
    for name, ddl in TABLES.items():
        full = f"{database}.{name}"
        if not spark.catalog.tableExists(full):
            spark.createDataFrame([], struct(ddl)).write.format("parquet").saveAsTable(full)
            continue
        have = set(spark.table(full).columns)
        for field in struct(ddl).fields:
            if field.name not in have:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({field.name} {field.dataType.simpleString()})")


def merge_latest(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Upsert: of several rows of a key the one latest by ``order`` wins in every column; NULL keys are kept as one key."""
    rest = [c for c in base.columns if c not in keys]
    return latest_rows(base.unionByName(updates.select(*base.columns)), keys, [order], rest).select(*base.columns)


def versions_of(records: DataFrame, key: str, version: str, order: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """One row for each (key, version), and whether it is the key's current one: that seen last. Two aggregations, no window,
    so a key with very many records is combined before the shuffle."""
    seen = latest_rows(records, [key, version], order, [*order, *[c for c in carried if c not in order]])
    last = seen.groupBy(key).agg(F.max(F.struct(*order, version)).alias("_last"))
    return seen.join(last, key).withColumn("is_current", F.col(version).eqNullSafe(F.col(f"_last.{version}"))).drop("_last")


def without_keys(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``gone``; rows with a NULL key stay."""
    return df.join(gone.select(F.col(key).alias("_gone")).distinct(), F.col(key) == F.col("_gone"), "left_anti")


def delete_files(catalog: DataFrame, versions: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog without the files, and versions in which theirs are no longer current."""
    paths = gone.select(F.col("file_path").alias("_gone")).distinct()
    marked = versions.join(paths, F.col("file_path") == F.col("_gone"), "left")
    return without_keys(catalog, gone, "file_path"), marked.withColumn("is_current", F.col("is_current") & F.col("_gone").isNull()).drop("_gone")


def delete_versions(tables: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The tables without the versions ``ids(document_version_id)``, children included."""
    out = {}
    for name, df in tables.items():
        key = "id" if name == "document_versions" else "document_version_id"
        out[name] = without_keys(df, ids.withColumnRenamed("document_version_id", key), key)
    return out


def cleared_from(checkpoints: DataFrame, start_stage: str, stages: Sequence[str] = STAGES) -> DataFrame:
    """Checkpoints of the stages before ``start_stage``; those of it and later ones are dropped."""
    return checkpoints.where(F.col("stage_name").isin(*stages[: stages.index(start_stage)]))


def latest_states(log: DataFrame) -> DataFrame:
    """The checkpoint log folded to its latest row for each (version, stage); a failed one has neither artifact nor checksum."""
    values = ["status", "stage_signature", "artifact_path", "artifact_checksum", "updated_at", "completed_at", "started_at", "created_at"]
    last = latest_rows(log, ["document_version_id", "stage_name"], ["updated_at", "completed_at", "started_at", "created_at"], values)
    status = F.lower(F.trim("status"))
    return last.withColumns(
        {
            "status": status,
            "artifact_path": F.when(status == "failed", "").otherwise(F.col("artifact_path")),
            "artifact_checksum": F.when(status == "failed", "").otherwise(F.col("artifact_checksum")),
        }
    )


def prunable_versions(versions: DataFrame, retain: int = 1) -> DataFrame:
    """Versions beyond the current and ``retain`` older ones of each path. Newest first: current, created_at, id."""
    w = Window.partitionBy("file_path").orderBy(F.col("is_current").desc_nulls_last(), F.col("created_at").desc_nulls_last(), F.col("id").desc())
    return versions.withColumn("version_rank", F.row_number().over(w)).where(F.col("version_rank") > max(retain, 0) + 1)


def prunable_artifacts(versions: DataFrame, checkpoints: DataFrame, retain: int = 1) -> DataFrame:
    """(id, file_path, artifact_paths) of the prunable versions; versions without artifacts have an empty list."""
    paths = checkpoints.where(F.col("artifact_path") != "").select("document_version_id", "artifact_path")
    gone = prunable_versions(versions, retain).select("id", "file_path")
    joined = gone.join(paths, gone["id"] == paths["document_version_id"], "left")
    return joined.groupBy("id", "file_path").agg(F.sort_array(F.collect_set("artifact_path")).alias("artifact_paths"))


def replace_versions(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Idempotent replacement of whole versions in a table partitioned by version: the partitions of ``rows`` are overwritten at once."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("document_version_id").parquet(path)


def content_rows(pages: DataFrame) -> DataFrame:
    """Rows of the content table with their defaults: blanks for missing texts, the unit's id, its search tokens."""
    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    return pages.select(
        "document_version_id",
        unit_id().alias("content_unit_id"),
        blank("chunk_id"),
        blank("section_id"),
        "page_number",
        blank("raw_content"),
        blank("chunk_context"),
        blank("chunk_header"),
        F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
        F.coalesce("entities", F.array().cast("array<string>")).alias("entities"),
        F.coalesce("token_count", F.lit(0)).alias("token_count"),
        F.regexp_extract_all(F.lower(F.coalesce("raw_content", F.lit(""))), F.lit("[a-z0-9]+"), 0).alias("tokens"),
    )


def unit_id() -> Column:
    """A chunk's id, or its page's number."""
    return F.coalesce(F.nullif(F.col("chunk_id"), F.lit("")), F.col("page_number").cast("string"))


def vector_or_null(vector: Column) -> Column:
    return F.when(F.size(vector) > 0, vector)


def next_ids(rows: DataFrame, taken: int) -> DataFrame:
    """Unique ids above ``taken``; not consecutive, so no global order is needed."""
    return rows.withColumn("id", F.lit(taken + 1) + F.monotonically_increasing_id())


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of all tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def completeness(pages: DataFrame) -> DataFrame:
    """Per version, in one pass: units, units with keywords, with a section, with tokens; complete if all have them."""
    return pages.groupBy("document_version_id").agg(
        F.count(F.lit(1)).alias("units"),
        F.count_if(F.size(F.coalesce("keywords", F.array().cast("array<string>"))) > 0).alias("with_keywords"),
        F.count_if(F.coalesce("section_id", F.lit("")) != "").alias("with_section"),
        F.count_if(F.coalesce("token_count", F.lit(0)) > 0).alias("with_tokens"),
    )
