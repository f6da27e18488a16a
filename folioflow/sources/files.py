"""File stores as tables: discovery scan and extraction of pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.incremental import ACCEPTED
from folioflow.operators.planning import path_context

PAGES = "file_path string, page_number int, raw_content string, error string"


def scan_files(spark: SparkSession, root: str, accepted: tuple[str, ...] = ACCEPTED) -> DataFrame:
    """Records of all files below the root's folders, with ``supported``. Hidden files and folders, and files directly under the
    root, are no records. The bytes are not read: only path, length and time are selected."""
    base = root.rstrip("/")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    path = F.regexp_replace("path", "^file:/+", "/")
    relative = F.regexp_replace(path, "^" + base.replace("file:", "") + "/", "")
    name = F.element_at(F.split(path, "/"), -1)
    kind = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    rows = listed.select(path.alias("file_path"), relative.alias("_rel"), F.col("length").alias("file_size"), F.unix_micros("modificationTime").alias("_time"))
    context = path_context(F.col("_rel"))
    return (
        rows.where(~F.col("_rel").rlike(r"(^|/)\.") & F.contains("_rel", F.lit("/")))
        .withColumn("_c", context)
        .select(
            "_c.*",
            F.element_at(F.split("file_path", "/"), -1).alias("filename"),
            F.lower(F.regexp_extract("file_path", r"\.([^./]*)$", 1)).alias("filetype"),
            "file_size",
            (F.col("_time") / 1e6).alias("date_last_modified"),
            F.lit("").alias("file_hash"),
            "file_path",
            F.lower(F.regexp_extract("file_path", r"\.([^./]*)$", 1)).isin(*accepted).alias("supported"),
        )
    )


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, file_hash) of files that have to be read; the digest is made in the JVM."""
    read = spark.read.format("binaryFile").load(paths)
    return read.select(F.regexp_replace("path", "^file:/+", "/").alias("file_path"), F.sha2("content", 256).alias("file_hash"))


def extract_pages(files: DataFrame, readers: dict[str, Callable[[bytes], list[str]]] | None = None) -> DataFrame:
    """(file_path, page_number, raw_content, error) of files (path, content) as ``binaryFile`` reads them.

    The reader goes by the extension; a type without one is an error row, and so is a file of which any page fails: then
    it has no pages. Files are read one at a time, so a task holds one file."""
    from folioflow.sources.office import READERS

    by_type = dict(READERS if readers is None else readers)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["file_path"], batch["content"], strict=True):
                kind = path.rpartition(".")[2].lower()
                try:
                    if kind not in by_type:
                        raise ValueError(f"no reader for {kind!r}")
                    pages = by_type[kind](content)
                    rows = [(path, i + 1, page, None) for i, page in enumerate(pages)]
                except Exception as error:  # a damaged file must not end the job
                    rows = [(path, 0, None, f"{type(error).__name__}: {error}"[:500])]
                yield pd.DataFrame(rows, columns=["file_path", "page_number", "raw_content", "error"])

    picked = files.select(F.regexp_replace("path", "^file:/+", "/").alias("file_path"), "content")
    return picked.mapInPandas(read, PAGES)
