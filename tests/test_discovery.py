import datetime as dt
import os

from folioflow.operators.incremental import IncrementalRun
from folioflow.streaming.discovery import new_files, process_stream

NOW = dt.datetime(2026, 6, 1, tzinfo=dt.UTC).timestamp()


def test_a_late_file_with_an_old_time_is_processed_once(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    run = IncrementalRun(spark, str(tmp_path / "state"), ["path"], ["modificationTime", "length"], "modificationTime")

    def arrive(name, age_days):
        (root / name).write_text(name)
        os.utime(root / name, (NOW - age_days * 86400,) * 2)
        process_stream(new_files(spark, str(root)), run, lambda b: b.select("path"), str(tmp_path / "checkpoint")).awaitTermination()

    def done():
        return sorted(os.path.basename(r["path"]) for r in run.output().collect())

    arrive("first", 0)
    arrive("second", -1)
    arrive("hours_old", 0.5)
    arrive("weeks_old", 60)
    assert done() == ["first", "hours_old", "second", "weeks_old"]


def test_a_stream_batch_passes_the_mark_of_a_batch_run(spark, tmp_path):
    run = IncrementalRun(spark, str(tmp_path / "state"), ["k"], ["v"], "at")
    day = lambda n: dt.datetime(2026, 1, n)
    schema = "k string, v int, at timestamp"
    run.run(spark.createDataFrame([("a", 1, day(5))], schema), lambda b: b, oldest_open=day(5))
    late = spark.createDataFrame([("a", 1, day(5)), ("b", 1, day(1))], schema)
    run.run(late, lambda b: b, whole=True)
    assert sorted(r["k"] for r in run.output().collect()) == ["a", "b"]
