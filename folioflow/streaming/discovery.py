"""Continuous discovery and processing of new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from folioflow.operators.incremental import IncrementalRun


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """A stream of the files that appear below ``root``, whatever their time; deletions are not seen, they need the batch diff."""
    read = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").option("maxFileAge", "36500d").schema("path string, modificationTime timestamp, length bigint, content binary").load(root)
    return read.select("path", "modificationTime", "length")


def process_stream(rows: DataFrame, run: IncrementalRun, step: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Each micro-batch goes through the ledger of an incremental run, so a batch that is repeated after a failure is not done twice.

    A file may be listed late or copied with its old time, and the stream gives it once only: no batch is cut by time, the ledger alone decides."""

    def each(batch: DataFrame, _: int) -> None:
        run.run(batch, step, whole=True)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
