"""Exchange formats: gzipped TSV dumps, JSON artifacts with checksums, traces, query suites."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from folioflow.schemas import TABLES, struct

TSV = {"sep": "\t", "nullValue": "\\N", "emptyValue": "", "escape": "\\", "quote": "", "header": "false"}
ARTIFACT = "document_version_id bigint, stage_name string, payload string, checksum string"


def dump_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, list[str]]:
    """Every table as gzipped TSV, arrays as JSON, line ends and tabs escaped; returns the columns written."""
    columns = {}
    for name, df in tables.items():
        def cell(f):
            c = F.to_json(f.name) if isinstance(f.dataType, ArrayType | StructType | MapType) else F.col(f.name).cast("string")
            for plain, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
                c = F.replace(c, F.lit(plain), F.lit(code))
            return F.coalesce(c, F.lit("\\N")).alias(f.name)

        df.select(F.concat_ws("\t", *[cell(f) for f in df.schema.fields]).alias("value")).write.mode("overwrite").option("compression", "gzip").text(f"{folder}/{name}")
        columns[name] = df.columns
    return columns


def load_table(spark: SparkSession, folder: str, name: str, ddl: str | None = None) -> DataFrame:
    """A table as ``dump_tables`` wrote it, in its schema."""
    schema = struct(ddl or TABLES[name])
    parts = spark.read.text(f"{folder}/{name}").select(F.split("value", "\t", -1).alias("c"))

    def value(i: int, f):
        raw = F.get("c", F.lit(i))
        text = F.when(raw != "\\N", raw)
        mark = "\u0001"
        text = F.replace(text, F.lit("\\\\"), F.lit(mark))
        for plain, code in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(code), F.lit(plain))
        text = F.replace(text, F.lit(mark), F.lit("\\"))
        if isinstance(f.dataType, ArrayType | StructType | MapType):
            return F.from_json(text, f.dataType).alias(f.name)
        return text.cast(f.dataType).alias(f.name)

    return parts.select(*[value(i, f) for i, f in enumerate(schema.fields)])


def artifact_rows(rows: DataFrame, stage: str, version: str = "document_version_id") -> DataFrame:
    """Stage results as artifacts: each row as JSON with its checksum."""
    payload = F.to_json(F.struct(*rows.columns))
    return rows.select(F.col(version).alias("document_version_id"), F.lit(stage).alias("stage_name"), payload.alias("payload")).withColumn("checksum", F.sha2("payload", 256))


def write_artifacts(rows: DataFrame, stage: str, folder: str) -> None:
    artifact_rows(rows, stage).write.mode("overwrite").partitionBy("stage_name").json(folder)


def read_artifacts(spark: SparkSession, folder: str, stage: str, ddl: str) -> DataFrame:
    """The stage's rows; a row whose checksum does not fit fails the read. Old payloads may call ``raw_content`` ``content``."""
    read = spark.read.schema(ARTIFACT).json(folder).where(F.col("stage_name") == stage)
    good = F.col("checksum") == F.sha2("payload", 256)
    checked = F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("checksum of version "), F.col("document_version_id").cast("string"))))
    schema = struct(ddl)
    names = schema.fieldNames()
    legacy = "raw_content" in names and "content" not in names
    parsed = read.select(F.from_json(checked, struct(ddl + ", content string") if legacy else schema).alias("p")).select("p.*")
    return parsed.withColumn("raw_content", F.coalesce("raw_content", "content")).drop("content") if legacy else parsed


#: Most cases of a suite.
SUITE = 10_000
TRACE_ID = re.compile(r"[0-9TZ]+_[0-9a-f]{8}")


def trace_id(created_at: str, text: str) -> str:
    """A run's id: its UTC time and eight hexadecimal digits."""
    return f"{re.sub('[^0-9TZ]', '', created_at)}_{hashlib.sha256(text.encode()).hexdigest()[:8]}"


def write_traces(units: DataFrame, folder: str, trace: str) -> None:
    """The units of a run (bank, period, source, payload columns) as JSON under the run's id."""
    safe_trace(trace)
    units.withColumn("trace_schema_version", F.lit(1)).write.mode("overwrite").json(f"{folder}/{trace}")


def read_trace(spark: SparkSession, folder: str, trace: str) -> DataFrame:
    return spark.read.json(f"{folder}/{safe_trace(trace)}")


def safe_trace(trace: str) -> str:
    """The id if it is one; a path in its place is refused."""
    if not TRACE_ID.fullmatch(trace):
        raise FileNotFoundError(trace)
    return trace


def query_suite(spark: SparkSession, path: str) -> DataFrame:
    """A suite of test questions from a JSON or, where the library is there, a YAML file."""
    text = spark.read.text(path, wholetext=True).head()[0]
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise ValueError("YAML suites need the yaml library; give the suite as JSON") from missing
        cases = yaml.safe_load(text)
    else:
        cases = json.loads(text)
    cases = cases.get("queries", []) if isinstance(cases, dict) else cases
    rows = [(c["name"], c["query"], [(x["bank"], x["period"]) for x in c.get("combos", [])], c.get("sources"), json.dumps(c.get("assertions", {}))) for c in cases]
    return spark.createDataFrame(rows, "name string, query string, combos array<struct<bank:string,period:string>>, sources array<string>, assertions string")


def write_suite(cases: DataFrame, path: str) -> None:
    """Test questions (name, query, combos, sources, assertions) as a suite of one JSON file; a suite is written by hand and small."""
    rows = [r.asDict(recursive=True) for r in cases.limit(SUITE + 1).collect()]
    if len(rows) > SUITE:
        raise ValueError(f"more than {SUITE} cases")
    body = json.dumps({"queries": [row | {"assertions": json.loads(row["assertions"] or "{}")} for row in rows]}, ensure_ascii=False)
    cases.sparkSession.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_results(results: DataFrame, path: str) -> None:
    """The results of a suite, a JSON object a line; NULL fields are written too."""
    results.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def list_traces(spark: SparkSession, folder: str) -> list[str]:
    """The ids of the runs below a folder, the newest first."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)]
    return sorted((n for n in names if TRACE_ID.fullmatch(n)), reverse=True)
