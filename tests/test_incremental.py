import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.operators import incremental as inc

T = dt.datetime(2026, 1, 1)
LOG = "document_version_id bigint, stage_name string, status string, stage_signature string, artifact_path string, artifact_checksum string, error_message string, started_at timestamp, created_at timestamp, updated_at timestamp, completed_at timestamp"
CATALOG = "snapshot_id int, delivered_at timestamp, data_source string, filter_1 string, filter_2 string, filter_3 string, filename string, filetype string, file_size bigint, date_last_modified double, file_hash string, file_path string"
VERSIONS = "id bigint, file_path string, data_source string, filter_1 string, filter_2 string, filter_3 string, filename string, filetype string, file_size bigint, date_last_modified double, file_hash string, is_current boolean, created_at timestamp"
H = {c: c * 64 for c in "abcdef"}


def file(path, digest, snapshot=1, hour=0, kind="pdf", size=1, mtime=1.0):
    return (snapshot, T + dt.timedelta(hours=hour), None, "", "", "", "x", kind, size, mtime, digest, path)


def version(i, path, digest, size=1, mtime=1.0):
    return (i, path, None, "", "", "", "x", "pdf", size, mtime, digest, True, T)


def mark(v, stage, status, signature, minute):
    return (v, stage, status, signature, "", "", "", T, T, T + dt.timedelta(minutes=minute), None)


def pending(spark, files, versions, marks, stages=("one", "two")):
    signatures = spark.createDataFrame([(i + 1, s, f"sig-{s}") for i, s in enumerate(stages)], "stage_order int, stage_name string, stage_signature string")
    out = inc.pending_files(
        spark.createDataFrame(files, CATALOG).withColumn("extra", F.lit(1)),
        spark.createDataFrame(versions, VERSIONS).withColumn("extra", F.lit(2)),
        spark.createDataFrame(marks, LOG).withColumn("extra", F.lit(3)),
        signatures,
    )
    return sorted((r["file_path"], r["first_stage"]) for r in out.collect())


def test_pending_files(spark):
    files = [
        file("/a", H["a"]),  # done
        file(" \\b\\\\x ", "SHA256:" + H["b"].upper()),  # second stage is old
        file("/c", H["c"]),  # not registered
        file("/d", None),  # by size and time
        file("/e", ""),  # no digest and nothing fits
        file("/f.txt", H["f"], kind="txt"),
        file("/g", H["a"], kind=None),
        file(None, H["a"]),
        file("/café", H["e"]),
        file("/a", H["b"], hour=-1),  # an earlier row of the same path
    ]
    versions = [version(1, "/a", H["a"]), version(2, "/b/x", H["b"]), version(4, "/d", H["d"]), version(9, "/d", H["e"]), version(5, "/e", H["e"], size=7), version(6, "/café", H["e"])]
    marks = [
        mark(1, "one", "succeeded", "sig-one", 1), mark(1, "two", " SUCCEEDED ", "sig-two", 1), mark(1, "two", "failed", "sig-two", 0),
        mark(2, "one", "succeeded", "sig-one", 1), mark(2, "two", "succeeded", "old", 1),
        mark(9, "one", "succeeded", "sig-one", 1), mark(9, "one", "running", "sig-one", 2), mark(None, "one", None, None, 1),
    ]
    assert pending(spark, files, versions, marks) == [("/b/x", "two"), ("/c", "one"), ("/café", "one"), ("/d", "one"), ("/e", "one")]


def test_pending_files_empty(spark):
    assert pending(spark, [], [], []) == []
    assert pending(spark, [file("/a", H["a"])], [], [], stages=()) == [("/a", "extraction")]


def test_only_the_newest_snapshot_counts(spark):
    assert pending(spark, [file("/a", H["a"], 1), file("/b", H["b"], 2)], [], []) == [("/b", "one")]


def test_low_water_mark(spark):
    rows = [("a", "running", T), ("b", "succeeded", T - dt.timedelta(days=9)), ("c", None, T - dt.timedelta(days=1))]
    log = spark.createDataFrame([(k, T, s, t) for k, s, t in rows], "k string, at timestamp, status string, started timestamp")
    assert inc.low_water_mark(log, ["k"], "at", "status", "started", ["succeeded", "failed"]).head()[0] == T - dt.timedelta(days=1)
    assert inc.low_water_mark(log.limit(0), ["k"], "at", "status", "started", ["succeeded"]).head()[0] is None


def test_runs_survive_failures_without_skipping_or_repeating(spark, tmp_path):
    schema = "k string, v int, at timestamp"
    hours = lambda n: T + dt.timedelta(hours=n)
    run = inc.IncrementalRun(spark, str(tmp_path / "state"), ["k"], ["v"], "at")
    first = spark.createDataFrame([("a", 1, hours(0)), ("b", 1, hours(1)), ("b", 1, hours(1)), (None, None, hours(1))], schema)
    run.run(first, lambda b: b, oldest_open=hours(1))
    # committed late: began before the last run looked and has an older time than rows that were done
    second = first.unionByName(spark.createDataFrame([("c", 1, hours(1)), ("b", 2, hours(3))], schema))

    def broken(batch):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        run.run(second, broken, oldest_open=hours(3))
    run.run(second, lambda b: b, oldest_open=hours(3))
    run.run(second, lambda b: b, oldest_open=hours(4))
    done = sorted((str(r["k"]), r["v"]) for r in run.output().collect())
    assert done == sorted([("a", 1), ("b", 1), ("None", None), ("c", 1), ("b", 2)], key=str)
    assert len(run.commits()) == 3


def test_ledgers_are_compacted_and_commits_read_at_once(spark, tmp_path):
    run = inc.IncrementalRun(spark, str(tmp_path / "state"), ["k"], ["v"], "at")
    run.COMPACT_EVERY = 2
    source = spark.createDataFrame([("a", 0, T)], "k string, v int, at timestamp")
    for n in range(5):
        source = source.unionByName(spark.createDataFrame([("a", n, T), (f"b{n}", None, None)], source.schema))
        run.run(source, lambda b: b)
    assert run.output().count() == run.output().distinct().count() == 10
    assert [len(c["ledgers"]) for c in run.commits()] == [1, 2, 1, 2, 1]


def test_a_failed_run_over_the_catalog_is_taken_up_where_it_stopped(spark):
    """Stages finish one by one, a run dies in between, and a signature changes: each file goes on from its first open stage, none is lost or done twice."""
    files = [file(f"/{k}", H[k]) for k in "abc"]
    versions = [version(i + 1, f"/{k}", H[k]) for i, k in enumerate("abc")]
    marks = [mark(1, "one", "succeeded", "sig-one", 1), mark(1, "two", "succeeded", "sig-two", 2), mark(2, "one", "succeeded", "sig-one", 1), mark(2, "two", "running", "sig-two", 2)]
    assert pending(spark, files, versions, marks) == [("/b", "two"), ("/c", "one")]
    marks += [mark(2, "two", "succeeded", "sig-two", 3), mark(3, "one", "succeeded", "sig-one", 3), mark(3, "two", "succeeded", "sig-two", 4)]
    assert pending(spark, files, versions, marks) == []
    marks.append(mark(1, "two", "succeeded", "sig-new", 9))
    assert pending(spark, files, versions, marks) == [("/a", "two")]
