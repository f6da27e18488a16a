"""What changed between consecutive full snapshots.

Each snapshot row becomes signed cells: +1 for the comparison with the snapshot before it, -1 for the one with
the snapshot after it; one cell for each compared field with its value, one that only marks the key's presence.
A cell on both sides sums to zero, so the sums that are left classify the key and name its changed fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.names import canonical_digest, canonical_path
from folioflow.session import small_side

PRESENCE = "\u0000key"


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each key: the one that comes last by ``order``, ties broken by the values, so that
    the result is defined. A plain aggregation: a key with many rows is combined before the shuffle."""
    payload = F.struct(*[F.col(v) for v in values])
    rank = F.struct(*[F.col(o) for o in order], *[F.col(v) for v in values if v not in order])
    return df.groupBy(*keys).agg(F.max_by(payload, rank).alias("_row")).select(*keys, "_row.*")


def signed_cells(snapshots: DataFrame, snapshot: str, key: str, fields: Sequence[str], ids: DataFrame | None = None) -> DataFrame:
    """Cells (pair, key, field, value, sign) of all consecutive pairs; ``pair`` is the later snapshot's id. ``ids`` may give rows
    with all snapshot ids where they are cheaper to read than from ``snapshots``.

    ``snapshots`` must hold one row for each (snapshot, key). NULL values give cells of their own."""
    snapshots = snapshots.select(snapshot, key, *fields)
    ids = (snapshots if ids is None else ids).select(F.col(snapshot).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    # one row for each snapshot, so the order over all of them is small by nature
    order = ids.select("_id", F.lead("_id").over(Window.orderBy("_id")).alias("_next"), F.lag("_id").over(Window.orderBy("_id")).alias("_prev"))
    sided = (
        snapshots.join(small_side(order), F.col(snapshot) == F.col("_id"))
        .select(
            key,
            *fields,
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.when(F.col("_prev").isNotNull(), F.col("_id")).alias("pair"), F.lit(1).alias("sign")),
                        F.struct(F.col("_next").alias("pair"), F.lit(-1).alias("sign")),
                    ),
                    lambda side: side["pair"].isNotNull(),
                )
            ).alias("_side"),
        )
        .select(F.col("_side.pair").alias("pair"), F.col("_side.sign").alias("sign"), key, *fields)
        # the rows move once, whole; their cells are made behind the shuffle and summed without another
        .repartition("pair", key)
    )
    cells = F.array(
        F.struct(F.lit(PRESENCE).alias("field"), F.lit("").alias("value")),
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields],
    )
    return sided.select("pair", F.col(key).alias("key"), "sign", F.explode(cells).alias("_cell")).select("pair", "key", "sign", "_cell.*")


def snapshot_changes(
    snapshots: DataFrame,
    snapshot: str,
    key: str,
    fields: Sequence[str],
    decisive: str | None = None,
    fallback: Sequence[str] = (),
    ids: DataFrame | None = None,
) -> DataFrame:
    """(pair, key, change, changed_fields) of each key that was added, removed or changed.

    ``decisive`` names a field that alone decides whether a key changed, as a digest does; if it is NULL on
    either side the ``fallback`` fields decide. Without it any field does. Keys that are NULL are ignored; an
    empty table, and a table with one snapshot, give no rows; the first snapshot is compared with nothing."""
    cells = signed_cells(snapshots.where(F.col(key).isNotNull()), snapshot, key, fields, ids)
    sums = cells.groupBy("pair", "key", "field", "value").agg(F.sum("sign").alias("total"), F.count(F.lit(1)).alias("cells"))

    def differs(field: Column) -> Column:
        return F.array_contains(F.col("changed_fields"), field)

    rows = sums.groupBy("pair", "key").agg(
        F.coalesce(F.sum(F.when(F.col("field") == PRESENCE, F.col("total"))), F.lit(0)).alias("presence"),
        F.sort_array(F.collect_set(F.when((F.col("field") != PRESENCE) & (F.col("total") != 0), F.col("field")))).alias("changed_fields"),
        (F.count_if((F.col("field") == F.lit(decisive)) & F.col("value").isNull()) if decisive else F.lit(0)).alias("unknown"),
    )
    if decisive:
        by_fallback = F.lit(False)
        for field in fallback:
            by_fallback = by_fallback | differs(F.lit(field))
        changed = F.when(F.col("unknown") > 0, by_fallback).otherwise(differs(F.lit(decisive)))
    else:
        changed = F.size("changed_fields") > 0
    change = F.when(F.col("presence") > 0, "added").when(F.col("presence") < 0, "removed").when(changed, "changed")
    return rows.select("pair", "key", change.alias("change"), F.when(F.col("presence") == 0, F.col("changed_fields")).alias("changed_fields")).where(
        F.col("change").isNotNull()
    )


def catalog_snapshots(catalog: DataFrame) -> DataFrame:
    """One row for each (snapshot_id, file_path) in canonical form: the one delivered last."""
    clean = catalog.select(
        "snapshot_id",
        "delivered_at",
        canonical_path(F.col("file_path")).alias("file_path"),
        canonical_digest(F.col("file_hash")).alias("file_hash"),
        "file_size",
        "date_last_modified",
        F.lower(F.trim("filetype")).alias("filetype"),
    )
    return latest_rows(clean, ["snapshot_id", "file_path"], ["delivered_at"], ["delivered_at", "file_hash", "file_size", "date_last_modified", "filetype"])


def catalog_changes(catalog: DataFrame) -> DataFrame:
    """(snapshot_id, file_path, change, changed_fields) of the file store's snapshots."""
    found = snapshot_changes(
        catalog_snapshots(catalog),
        "snapshot_id",
        "file_path",
        ["file_hash", "file_size", "date_last_modified"],
        decisive="file_hash",
        fallback=["file_size", "date_last_modified"],
        ids=catalog,
    )
    return found.select(F.col("pair").alias("snapshot_id"), F.col("key").alias("file_path"), "change", "changed_fields")
