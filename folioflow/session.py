"""Session helpers: settings, reliable checkpoints, bounded broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that suit any size of cluster; an operator never depends on them for right results.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Most rows a side may have to be broadcast by hint.
BROADCAST_ROWS = 20_000


def local_session(cores: str = "8", partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("folioflow")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of this machine's; elsewhere that would lose data with its machine, so it is an error."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="folioflow-")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as local rows with a broadcast hint if it has at most ``limit`` of them, so that what is above it runs once; else unchanged,
    so that Spark shuffles it."""
    rows = df.take(limit + 1)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
