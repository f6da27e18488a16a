"""Discovery diffs and execution plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.operators.store import latest_states
from folioflow.schemas import STAGES
from folioflow.session import small_side


def path_context(relative: Column) -> Column:
    """Struct (data_source, filter_1, filter_2, filter_3) of a relative path of a file: its folders by position, the fourth
    and later ones joined; '' for those that are missing."""
    parts = F.filter(F.split(relative, "/"), lambda p: p != "")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    at = [F.coalesce(F.get(folders, F.lit(i)), F.lit("")) for i in range(3)]
    rest = F.array_join(F.slice(folders, 4, F.greatest(F.size(folders) - 3, F.lit(0))), "/")
    return F.struct(at[0].alias("data_source"), at[1].alias("filter_1"), at[2].alias("filter_2"), F.coalesce(rest, F.lit("")).alias("filter_3"))


def with_context(records: DataFrame, root: str) -> DataFrame:
    """Records whose four context fields are all blank get those of their path below ``root``; others keep theirs."""
    fields = ("data_source", "filter_1", "filter_2", "filter_3")
    blank = F.lit(True)
    for f in fields:
        blank = blank & (F.coalesce(F.col(f), F.lit("")) == "")
    derived = path_context(F.regexp_replace("file_path", "^" + root.rstrip("/") + "/", ""))
    out = records.withColumns({"_d": derived, "_blank": blank})
    return out.withColumns({f: F.when(F.col("_blank"), F.col(f"_d.{f}")).otherwise(F.coalesce(F.col(f), F.lit(""))) for f in fields}).drop("_d", "_blank")


def glob_pattern(glob: str) -> str:
    """A shell pattern as a regular expression."""
    import fnmatch

    return fnmatch.translate(glob).replace("(?s:", "(?s)(?:").replace(r"\Z", "$").replace(r"\z", "$")


def selected(paths: Sequence[str] = (), globs: Sequence[str] = (), path: str = "file_path", name: str = "filename") -> Column:
    """Whether a record is on the list of paths (if there is one) and matches any pattern by path or name (if there is one)."""
    keep = F.col(path).isin(*paths) if paths else F.lit(True)
    if globs:
        hit = F.lit(False)
        for g in globs:
            hit = hit | F.col(path).rlike(glob_pattern(g)) | F.col(name).rlike(glob_pattern(g))
        keep = keep & hit
    return keep


def catalog_diff(discovered: DataFrame, cataloged: DataFrame) -> DataFrame:
    """(file_path, status): new, modified, deleted or unchanged. A file of another size is modified; of the same size and
    time it is not; of the same size and another time it is unless both digests are known and equal."""
    a = discovered.select("file_path", F.col("file_size").alias("s1"), F.col("date_last_modified").alias("t1"), F.nullif("file_hash", F.lit("")).alias("h1"), F.lit(1).alias("in_a"))
    b = cataloged.select("file_path", F.col("file_size").alias("s2"), F.col("date_last_modified").alias("t2"), F.nullif("file_hash", F.lit("")).alias("h2"), F.lit(1).alias("in_b"))
    status = (
        F.when(F.col("in_b").isNull(), "new")
        .when(F.col("in_a").isNull(), "deleted")
        .when(~F.col("s1").eqNullSafe(F.col("s2")), "modified")
        .when(F.col("t1").eqNullSafe(F.col("t2")), "unchanged")
        .when(F.col("h1") == F.col("h2"), "unchanged")
        .otherwise("modified")
    )
    return a.join(b, "file_path", "full_outer").select("file_path", status.alias("status"))


def needs_digest(discovered: DataFrame, cataloged: DataFrame) -> DataFrame:
    """The files whose digest decides: same size, other time. Only these have to be read."""
    b = cataloged.select("file_path", F.col("file_size").alias("s2"), F.col("date_last_modified").alias("t2"))
    return discovered.join(b, "file_path").where((F.col("file_size") == F.col("s2")) & (F.col("date_last_modified") != F.col("t2"))).drop("s2", "t2")


def usable(checkpoints: DataFrame, signatures: DataFrame) -> DataFrame:
    """Latest checkpoints with ``stage_order`` and whether they can be built on: succeeded under the signature in force, with an
    artifact and a checksum."""
    joined = latest_states(checkpoints).join(small_side(signatures.select("stage_name", "stage_order", F.col("stage_signature").alias("_in_force"))), "stage_name")
    ok = (F.col("status") == "succeeded") & (F.col("stage_signature") == F.col("_in_force")) & (F.col("artifact_path") != "") & (F.col("artifact_checksum") != "")
    return joined.withColumn("usable", F.coalesce(ok, F.lit(False))).drop("_in_force")


def resume_plans(versions: DataFrame, checkpoints: DataFrame, signatures: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """(document_version_id, completed, start_stage, action) of the current versions: the longest run of usable stages from the first,
    and the stage to go on with; ``skip`` if all are usable."""
    n = len(stages)
    orders = F.array_sort(F.collect_set(F.when(F.col("usable"), F.col("stage_order"))))
    done = usable(checkpoints, signatures).groupBy("document_version_id").agg(orders.alias("_orders"))
    current = versions.where("is_current").select(F.col("id").alias("document_version_id"))
    # the run is as long as positions equal orders
    run = F.size(F.filter(F.col("_orders"), lambda x, i: x == i + 1))
    joined = current.join(done, "document_version_id", "left").withColumn("completed", F.coalesce(F.when(F.col("_orders").isNotNull(), run), F.lit(0)))
    names = F.array(*[F.lit(s) for s in stages])
    return joined.select(
        "document_version_id",
        "completed",
        F.when(F.col("completed") < n, F.get(names, F.col("completed"))).alias("start_stage"),
        F.when(F.col("completed") >= n, "skip").when(F.col("completed") == 0, "full").otherwise("resume").alias("action"),
    )


def forced(plans: DataFrame, stage: str | None = None, stages: Sequence[str] = STAGES) -> DataFrame:
    """Plans that go on from a stage whatever is done, or from the first one. A version that has not come as far as the stage keeps its plan, since what the
    stage builds on is missing."""
    at = stages.index(stage) if stage else 0
    reached = F.col("completed") >= at
    return plans.withColumns({
        "completed": F.when(reached, F.lit(at)).otherwise(F.col("completed")),
        "start_stage": F.when(reached, F.lit(stages[at])).otherwise(F.col("start_stage")),
        "action": F.when(reached, F.lit("full" if at == 0 else "resume")).otherwise(F.col("action")),
    })


def stage_range(first: str | None = None, last: str | None = None, stages: Sequence[str] = STAGES) -> list[str]:
    low = stages.index(first) if first else 0
    high = stages.index(last) if last else len(stages) - 1
    return list(stages[low : high + 1])


def checkpoints_by_version(checkpoints: DataFrame) -> DataFrame:
    """(document_version_id, statuses): a map from stage to latest status."""
    last = latest_states(checkpoints).where(F.col("stage_name").isNotNull())
    return last.groupBy("document_version_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stage_name", "status")))).alias("statuses"))
