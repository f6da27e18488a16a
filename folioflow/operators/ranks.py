"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import checkpointed, small_side

#: Rows of a group from which it is numbered by several tasks. Both ways give the same numbers if the order is total.
HOT_ROWS = 5_000_000
UNCOUNTED = object()


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[Column], into: str, hot_rows: int = HOT_ROWS, bound: DataFrame | None = None, hot=UNCOUNTED) -> DataFrame:
    """``df`` with ``into``: each row's place in its group by ``order``, from 1. ``bound``: rows of which each group has at least as many
    as in ``df``, if those are cheaper to count; ``hot``: the groups of very many rows, or None for none, if that is known.

    Groups of usual size take one window. Larger ones are spread by ranges of (group, order), numbered range by range, and raised by the
    rows in the ranges before; the ranges are fixed in a checkpoint first, since sampling them anew could move rows."""
    window = Window.partitionBy(*group).orderBy(*order)
    if hot is UNCOUNTED:
        hot = (df if bound is None else bound).groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*group)
        hot = hot if hot.take(1) else None
    if hot is None:
        return df.withColumn(into, F.row_number().over(window))
    named = small_side(hot.select(*[F.col(g).alias(f"_hot_{g}") for g in group]))
    same = [F.col(g).eqNullSafe(F.col(f"_hot_{g}")) for g in group]
    usual = df.join(named, same, "left_anti").withColumn(into, F.row_number().over(window))
    spread = df.join(named, same, "left_semi").repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_part", F.spark_partition_id())
    spread = checkpointed(spread)
    inside = spread.withColumn("_no", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order)))
    sizes = spread.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"_o_{g}") for g in group], F.col("_part").alias("_o_part"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    on = [F.col(g).eqNullSafe(F.col(f"_o_{g}")) for g in group] + [F.col("_part") == F.col("_o_part")]
    numbered = inside.join(offsets, on).withColumn(into, (F.col("_no") + F.col("_before")).cast("int"))
    return usual.unionByName(numbered.select(*df.columns, into))
