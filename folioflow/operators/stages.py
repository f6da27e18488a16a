"""Running a document set through stages: signatures, states, artifacts, the single-writer lock, retention."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "document_version_id bigint, stage_name string, status string, stage_signature string, artifact_path string, artifact_checksum string, error_message string, updated_at timestamp"


def signature(stage: Column, configuration: Column, code: Column | None = None) -> Column:
    """The fingerprint of a stage: of its name, its configuration and, if given, its code, parted by NUL."""
    parts = [stage, configuration, *([code] if code is not None else [])]
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def row_checksum(columns: Sequence[str]) -> Column:
    """Aggregate: the fingerprint of a table's rows, whatever their order and partitions."""
    return F.sha2(F.concat_ws(",", F.count(F.lit(1)).cast("string"), F.bit_xor(F.xxhash64(*columns)).cast("string"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")), 256)


def verified(checkpoints: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Checkpoints with ``artifact_ok``: their artifact is there with the checksum they name. ``artifacts``: (artifact_path, checksum), one row for each."""
    there = artifacts.select("artifact_path", F.col("checksum").alias("_checksum"))
    same = F.coalesce(F.lower("artifact_checksum") == F.lower("_checksum"), F.lit(False)) & (F.coalesce("artifact_path", F.lit("")) != "")
    return checkpoints.join(there, "artifact_path", "left").withColumn("artifact_ok", same).drop("_checksum")


class StageRun:
    """Runs a document set's stages in order in a folder that all executors share.

    ``state/`` is a log with a row for each version, stage and change of state; ``artifacts/stage=<name>/`` holds what a stage gave. A stage that fails leaves
    the state failed with its message and no artifact. A run goes on behind the last stage that succeeded under the signature in force and whose artifact still
    has its checksum; a changed signature runs that stage and all after it again."""

    def __init__(self, spark: SparkSession, folder: str, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], signatures: Mapping[str, str]):
        self.spark, self.folder, self.stages, self.signatures = spark, folder.rstrip("/"), list(stages), dict(signatures)

    def _log(self, versions: DataFrame, stage: str, status: str, path: str = "", checksum: str = "", error: str = "") -> None:
        rows = versions.select(
            F.col("document_version_id").cast("bigint"), F.lit(stage).alias("stage_name"), F.lit(status).alias("status"), F.lit(self.signatures[stage]).alias("stage_signature"),
            F.lit(path).alias("artifact_path"), F.lit(checksum).alias("artifact_checksum"), F.lit(error).alias("error_message"), F.current_timestamp().alias("updated_at"),
        ).distinct()
        rows.write.mode("append").parquet(f"{self.folder}/state")

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.folder}/state")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], LOG)
            raise

    def _usable(self, stage: str) -> str | None:
        """The artifact of a stage, if its last state is succeeded under the signature in force and its rows have the checksum."""
        last = self.log().where(F.col("stage_name") == stage).groupBy("stage_name").agg(F.max_by(F.struct("status", "stage_signature", "artifact_path", "artifact_checksum"), "updated_at").alias("s")).select("s.*").head()
        if last is None or last["status"] != "succeeded" or last["stage_signature"] != self.signatures[stage]:
            return None
        try:
            found = self.spark.read.parquet(last["artifact_path"])
            return last["artifact_path"] if found.agg(row_checksum(found.columns)).head()[0] == last["artifact_checksum"] else None
        except Exception:  # an artifact that cannot be read is none
            return None

    def run(self, source: DataFrame) -> DataFrame:
        """The last stage's result; every row has a ``document_version_id``."""
        versions, rows, usable = source.select("document_version_id").distinct(), source, True
        for name, step in self.stages:
            path = self._usable(name) if usable else None
            if path is None:
                usable = False
                path = f"{self.folder}/artifacts/stage={name}/run={uuid.uuid4().hex}"
                self._log(versions, name, "running")
                try:
                    step(rows).write.parquet(path)
                    written = self.spark.read.parquet(path)
                    self._log(versions, name, "succeeded", path, written.agg(row_checksum(written.columns)).head()[0])
                except Exception as error:
                    self._delete(path)
                    self._log(versions, name, "failed", error=f"{type(error).__name__}: {error}"[:500])
                    raise
            rows = self.spark.read.parquet(path)
        return rows

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class WriterLock:
    """Lets one writer at a time into a folder: a file that only one can create, with the owner and the time of the last heartbeat. A lock whose heartbeat is
    older than ``stale_seconds`` is taken over."""

    def __init__(self, spark: SparkSession, folder: str, stale_seconds: float = 6 * 3600, clock: Callable[[], float] = time.time):
        self.spark, self.owner, self.stale, self.clock = spark, uuid.uuid4().hex, stale_seconds, clock
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/writer.lock")
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _write(self, replace: bool) -> None:
        stream = self.fs.create(self.path, replace)
        stream.write(bytearray(json.dumps({"owner": self.owner, "beat": self.clock()}).encode()))
        stream.close()

    def held_by(self) -> dict | None:
        if not self.fs.exists(self.path):
            return None
        text = self.spark.read.text(self.path.toString(), wholetext=True).head()
        return json.loads(text[0]) if text else None

    def acquire(self) -> bool:
        held = self.held_by()
        if held is not None:
            if self.clock() - held["beat"] <= self.stale:
                return False
            self.fs.delete(self.path, False)
        try:
            self._write(replace=False)
        except Exception:  # another writer was first
            return False
        return self.held_by()["owner"] == self.owner

    def heartbeat(self) -> bool:
        """Renews the lock; False if it is no longer this writer's."""
        held = self.held_by()
        if held is None or held["owner"] != self.owner:
            return False
        self._write(replace=True)
        return True

    def release(self) -> None:
        held = self.held_by()
        if held is not None and held["owner"] == self.owner:
            self.fs.delete(self.path, False)


def retained(names: DataFrame, group: Sequence[str], name: str, keep: int) -> DataFrame:
    """Rows with ``kept``: whether they are among their group's ``keep`` last by name. NULL names come first."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(name).desc_nulls_last()))
    return names.withColumn("kept", place <= keep)


def fresh_ids(rows: DataFrame, taken: int, order: Sequence[str]) -> DataFrame:
    """Consecutive ids above ``taken`` in the given order, made range by range without one task that sees all rows."""
    from folioflow.session import checkpointed

    spread = checkpointed(rows.repartitionByRange(*[F.col(o) for o in order]).withColumn("_part", F.spark_partition_id()))
    sizes = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return spread.join(before, "_part").withColumn("id", F.lit(taken) + F.col("_before") + inside).drop("_part", "_before")


def wiped(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, int]:
    """Empties tables (name to folder) children first, keeping their schema; the next id of each is 1."""
    for path in reversed(list(tables.values())):
        schema = spark.read.parquet(path).schema
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return dict.fromkeys(tables, 1)
