"""Processing only new or changed records.

A run rereads the source from the start of the oldest transaction that was open when the last run looked, so that
nothing committed late is skipped, and anti-joins (key, version) pairs against the ledger of what was processed,
so that the overlap is not done twice. The ledger counts only if its run was committed."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.snapshots import catalog_snapshots, latest_rows
from folioflow.session import small_side

ACCEPTED = ("pdf", "docx", "pptx", "xlsx")


def low_water_mark(log: DataFrame, keys: Sequence[str], order: str, status: str, started: str, closed: Sequence[str]) -> DataFrame:
    """One row ``mark``: when the oldest transaction began whose latest state is none of ``closed``; NULL if all are closed.

    A state that is NULL counts as open."""
    return low_water_mark_of(latest_rows(log, keys, [order], [status, started]), status, started, closed)


def low_water_mark_of(last: DataFrame, status: str, started: str, closed: Sequence[str]) -> DataFrame:
    """The same of transactions that have one row each, their latest."""
    is_open = ~F.coalesce(F.lower(F.trim(status)).isin(*closed), F.lit(False))
    return last.agg(F.min(F.when(is_open, F.col(started))).alias("mark"))


def unprocessed(pairs: DataFrame, ledger: DataFrame, on: Sequence[str]) -> DataFrame:
    """The (key, version) pairs that the ledger lacks. NULLs in ``on`` equal each other, so a NULL version is processed once."""
    ledger = ledger.select(*[F.col(c).alias(f"_l_{c}") for c in on])
    condition = [pairs[c].eqNullSafe(F.col(f"_l_{c}")) for c in on]
    return pairs.join(ledger, condition, "left_anti")


def next_batch(source: DataFrame, ledger: DataFrame, key: Sequence[str], version: Sequence[str], committed_at: str, since, repeats: bool = True) -> DataFrame:
    """The source's rows from ``since`` on (all if it is None), repeats dropped, that the ledger lacks. ``since``: a time, or a column of the source.

    A row whose commit time is NULL is always reread. Of equal (key, version) pairs the earliest row is taken; ``repeats`` says whether there may be any."""
    mark = since if isinstance(since, Column) else F.lit(since)
    window = source if since is None else source.where(F.col(committed_at).isNull() | mark.isNull() | (F.col(committed_at) >= mark))
    on = [*key, *version]
    if not repeats:
        return unprocessed(window, ledger, on)
    rest = [c for c in window.columns if c not in on]
    once = window.groupBy(*on).agg(F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in rest if c == committed_at] or [F.lit(0)])).alias("_row"))
    return unprocessed(once.select(*on, "_row.*"), ledger, on)


class IncrementalRun:
    """Runs a step over new or changed records only, with its state in a folder that all executors share.

    Layout: ``ledger/run=<id>/`` holds the pairs of a run, ``output/run=<id>/`` its result and ``commits/<number>.json``
    marks it as done and names the ledgers that count from then on. A run that fails before its commit leaves no mark: its ledger and output do not
    count, and the next run takes the same records again. The commit is one rename that must not replace a file, as in HDFS or a local folder;
    a store without such a rename needs a table format's commit instead. Every ``COMPACT_EVERY`` runs the ledgers are written as one."""

    COMPACT_EVERY = 50

    def __init__(self, spark: SparkSession, folder: str, key: Sequence[str], version: Sequence[str], committed_at: str):
        self.spark, self.folder, self.key, self.version, self.committed_at = spark, folder.rstrip("/"), list(key), list(version), committed_at

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _commit_names(self) -> list[str]:
        fs, path = self._fs()
        base = path(f"{self.folder}/commits")
        return sorted(s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().endswith(".json")) if fs.exists(base) else []

    def commits(self) -> list[dict]:
        """All commits in order, in one read."""
        if not self._commit_names():
            return []
        return sorted((json.loads(r[0]) for r in self.spark.read.text(f"{self.folder}/commits/*.json", wholetext=True).toLocalIterator()), key=lambda c: c["order"])

    def last_commit(self) -> dict | None:
        names = self._commit_names()
        return json.loads(self.spark.read.text(f"{self.folder}/commits/{names[-1]}", wholetext=True).head()[0]) if names else None

    def ledger(self, commit: dict | None, empty: DataFrame) -> DataFrame:
        """The pairs that were processed up to a commit."""
        on = [*self.key, *self.version]
        if commit is None:
            return empty.select(*on).limit(0)
        return self.spark.read.parquet(*[f"{self.folder}/ledger/run={r}" for r in commit["ledgers"]]).select(*on)

    def output(self) -> DataFrame | None:
        runs = [f"{self.folder}/output/run={c['run']}" for c in self.commits()]
        return self.spark.read.parquet(*runs) if runs else None

    def run(self, source: DataFrame, step: Callable[[DataFrame], DataFrame], oldest_open=None, whole: bool = False) -> str:
        """Process what is new. ``oldest_open``: when the oldest transaction now open began, or now if none is; the next
        run rereads from there. None rereads everything, which is slower but never wrong. ``whole``: the source holds each record once
        only, however old, as a stream's batch does, so none is passed over by its time."""
        last = self.last_commit()
        since = last["oldest_open"] if last and not whole else None
        run, on = uuid.uuid4().hex, [*self.key, *self.version]
        batch = next_batch(source, self.ledger(last, source), self.key, self.version, self.committed_at, since)
        pending = f"{self.folder}/batch/run={run}"
        batch.write.parquet(pending)  # the batch is fixed before the step sees it: a retried task reads the same rows
        batch = self.spark.read.parquet(pending)
        step(batch).write.mode("overwrite").parquet(f"{self.folder}/output/run={run}")
        pairs, ledgers = batch.select(*on), [*(last["ledgers"] if last else []), run]
        if len(ledgers) > self.COMPACT_EVERY:
            pairs, ledgers = pairs.unionByName(self.ledger(last, pairs)), [run]
        pairs.write.mode("overwrite").parquet(f"{self.folder}/ledger/run={run}")
        fs, path = self._fs()
        order = last["order"] + 1 if last else 0
        mark = {"run": run, "order": order, "oldest_open": None if oldest_open is None else str(oldest_open), "ledgers": ledgers}
        draft = f"{self.folder}/draft-{run}"
        stream = fs.create(path(draft))
        stream.write(bytearray(json.dumps(mark).encode()))
        stream.close()
        fs.mkdirs(path(f"{self.folder}/commits"))
        if not fs.rename(path(draft), path(f"{self.folder}/commits/{order:010d}.json")):
            raise RuntimeError(f"another run committed {os.path.basename(self.folder)} first")
        fs.delete(path(pending), True)
        return run


def latest_stages(checkpoints: DataFrame) -> DataFrame:
    """(document_version_id, stage_name, status, stage_signature, started_at) of the row of each version and stage that was updated last."""
    return latest_rows(
        # without a stage's name there is no stage
        checkpoints.where(F.col("stage_name").isNotNull()).select("document_version_id", "stage_name", "status", "stage_signature", "updated_at", "completed_at", "started_at", "created_at"),
        ["document_version_id", "stage_name"],
        ["updated_at", "completed_at", "started_at", "created_at"],
        ["status", "stage_signature", "started_at"],
    ).withColumn("status", F.lower(F.regexp_replace("status", r"(?U)^\s+|\s+$", "")))


def processed_ledger(stages: DataFrame, signatures: DataFrame) -> DataFrame:
    """(document_version_id, stage_name, stage_signature) pairs whose latest row, of ``latest_stages``, succeeded under the signature in force."""
    done = stages.where(F.col("status") == "succeeded")
    return done.join(small_side(signatures.select("stage_name", "stage_signature")), ["stage_name", "stage_signature"]).select(
        "document_version_id", "stage_name", "stage_signature"
    )


def current_files(catalog: DataFrame, versions: DataFrame, newest, accepted: Sequence[str] = ACCEPTED) -> DataFrame:
    """(file_path, document_version_id, delivered_at) of the accepted files of the snapshot ``newest``; the version is NULL if none is registered."""
    files = catalog_snapshots(catalog.where(F.col("snapshot_id") == F.lit(newest))).where(F.col("filetype").isin(*accepted) & F.col("file_path").isNotNull())
    registered = versions.select(
        F.col("id").alias("_version"),
        F.col("file_path").alias("_path"),
        F.col("file_hash").alias("_hash"),
        F.col("file_size").alias("_size"),
        F.col("date_last_modified").alias("_time"),
    )
    same = (F.col("file_hash") == F.col("_hash")) | (
        F.col("file_hash").isNull() & (F.col("file_size") == F.col("_size")) & (F.col("date_last_modified") == F.col("_time"))
    )
    joined = files.join(registered, (files["file_path"] == registered["_path"]), "left")
    # a path has few versions; the condition is an aggregate's, so that a path whose versions all fail it stays
    return joined.groupBy("file_path").agg(F.max(F.when(same, F.col("_version"))).alias("document_version_id"), F.max("delivered_at").alias("delivered_at"))


def pending_files(catalog: DataFrame, versions: DataFrame, checkpoints: DataFrame, signatures: DataFrame) -> DataFrame:
    """(file_path, document_version_id, first_stage): the files the next run must process, each with the stage to go on from.

    The records are (version, stage, signature), committed when their file was delivered. They are reread from the start of the oldest transaction
    that was open at the last run: the oldest stage that has neither succeeded nor failed, or the delivery of the newest snapshot, whose files
    no run has closed yet. What is done under the signature in force is removed by the anti-join with
    the ledger, so a signature that changes reopens files of any age. NULL keys and paths are no files; a NULL state is open; equal rows count
    once; empty tables give no rows."""
    began = F.struct("snapshot_id", F.col("_began").alias("began"))
    newest = catalog.groupBy("snapshot_id").agg(F.min("delivered_at").alias("_began")).agg(F.max(began).alias("s")).select("s.*").head()
    files = current_files(catalog, versions, newest[0])
    stages = [tuple(r) for r in signatures.select("stage_order", "stage_name", "stage_signature").orderBy("stage_order").take(1001)]
    if len(stages) > 1000:
        raise ValueError("more than 1,000 stages")
    fresh = files.where(F.col("document_version_id").isNull()).select(
        "file_path", "document_version_id", F.lit(stages[0][1] if stages else "extraction").alias("first_stage")
    )
    if not stages:
        return fresh
    plan = F.array(
        *[
            F.struct(F.lit(o).alias("stage_order"), F.lit(n).alias("stage_name"), F.lit(s).alias("stage_signature"))
            for o, n, s in stages
        ]
    )
    last = latest_stages(checkpoints)
    opened = low_water_mark_of(last, "status", "started_at", ("succeeded", "failed"))
    mark = opened.select(F.least("mark", F.lit(newest[1]).cast("timestamp")).alias("_since"))
    due = files.where(F.col("document_version_id").isNotNull()).join(F.broadcast(mark))  # mark: one row
    due = due.select("file_path", "document_version_id", "delivered_at", "_since", F.explode(plan).alias("_s")).select("file_path", "document_version_id", "delivered_at", "_since", "_s.*")
    # a version has one path and each stage once, so no pair comes twice
    left = next_batch(due, processed_ledger(last, signatures), ["document_version_id", "stage_name"], ["stage_signature"], "delivered_at", F.col("_since"), repeats=False)
    resumed = left.groupBy("file_path", "document_version_id").agg(F.min_by("stage_name", "stage_order").alias("first_stage"))
    return resumed.unionByName(fresh)
