"""One ranking from several differently-scaled scores.

Within a query every score is replaced by its rank, which removes range, spread and outliers. The correlation matrix of
the rank columns over all items is summed in one distributed pass; its first principal component weighs the scores. The
signs of the loadings follow the declared directions, and items are sorted by their projection."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.ranks import row_numbers
from folioflow.session import checkpointed, small_side

#: Rows of a query from which it is ranked bucket by bucket instead of in one task. Both ways give the same ranks.
HOT_ROWS = 2_000_000
#: Tasks among which the rows of one value of such a query are spread.
SALTS = 16


def directed_value(high_is_good: Column, low_is_good: Column) -> Column:
    """One value of which more is better; NULL if a row has neither value. NaN counts as no value."""
    high = F.when(~F.isnan(high_is_good), high_is_good)
    low = F.when(~F.isnan(low_is_good), low_is_good)
    return F.coalesce(high, -low)


def _bucket(value: Column) -> Column:
    """An integer that never falls as the value rises."""
    return F.least(F.greatest(F.floor(F.signum(value) * F.least(F.log1p(F.abs(value) * 1000), F.lit(1e9)) * 2048), F.lit(-(10**15))), F.lit(10**15))


def _ranks_in_one_task(best: DataFrame) -> DataFrame:
    """Ascending mean rank and number of ranked units of each (query, source)."""
    source = Window.partitionBy("query", "source")
    return best.select(
        "query",
        "source",
        "unit",
        (F.rank().over(source.orderBy("value")) + (F.count(F.lit(1)).over(Window.partitionBy("query", "source", "value")) - 1) / 2.0).alias("rank"),
        F.count(F.lit(1)).over(source).alias("ranked"),
    )


def _ranks_by_bucket(best: DataFrame) -> DataFrame:
    """The same for queries of any size: equal values are counted first, values are ordered inside narrow buckets,
    and the buckets' sums give the rows before them. No task holds a whole query."""
    keyed = best.withColumn("bucket", _bucket(F.col("value")))
    values = keyed.groupBy("query", "source", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("query", "source", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    buckets = keyed.groupBy("query", "source", "bucket").agg(F.count(F.lit(1)).alias("size"))
    upto = Window.partitionBy("query", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(
        "query",
        "source",
        "bucket",
        F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("below"),
        F.sum("size").over(Window.partitionBy("query", "source")).alias("ranked"),
    )
    ranks = values.join(buckets, ["query", "source", "bucket"]).select(
        "query", "source", "value", (F.col("below") + F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"), "ranked"
    )
    # a value that many units share meets its rank in SALTS tasks
    salted = ranks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return keyed.withColumn("salt", F.pmod(F.xxhash64("unit"), F.lit(SALTS)).cast("int")).join(salted, ["query", "source", "value", "salt"]).select("query", "source", "unit", "rank", "ranked")


def _rank_columns(ranks: DataFrame, sources: Sequence[str]) -> DataFrame:
    """(query, unit, r0..rk): ranks scaled to (0, 1) among all units of the query. A unit that a source did not
    return shares the lowest ranks with all such units; a source without any unit gives everyone 0.5."""
    units = ranks.groupBy("query", "unit").agg(*[F.max(F.when(F.col("source") == s, F.struct("rank", "ranked"))).alias(f"s{i}") for i, s in enumerate(sources)])
    totals = units.groupBy("query").agg(F.count(F.lit(1)).alias("n"), *[F.max(f"s{i}.ranked").alias(f"m{i}") for i in range(len(sources))])
    joined = units.join(totals, "query")
    m = [F.coalesce(F.col(f"m{i}"), F.lit(0)) for i in range(len(sources))]
    return joined.select(
        "query",
        "unit",
        *[
            ((F.coalesce(F.col("n") - m[i] + F.col(f"s{i}.rank"), (F.col("n") - m[i] + 1) / 2.0) - 0.5) / F.col("n")).alias(f"r{i}")
            for i in range(len(sources))
        ],
    )


def valued_rows(hits: DataFrame, query: str, source: str, unit: str, value: Column) -> DataFrame:
    return hits.select(F.col(query).alias("query"), F.col(source).alias("source"), F.col(unit).alias("unit"), value.alias("value")).dropna()


def survey(rows: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[list[str], DataFrame | None]:
    """The sources, and the queries of more than ``hot_rows`` rows if there are any, from one scan.

    The driver gets one row: the names of the sources, which become columns, and whether there are such queries."""
    by_query = rows.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.collect_set("source").alias("sources"))
    seen = by_query.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources")))).alias("sources"), F.max("n").alias("most")).head()
    hot = by_query.where(F.col("n") > hot_rows).select("query") if (seen["most"] or 0) > hot_rows else None
    return seen["sources"] or [], hot


def rank_columns(rows: DataFrame, sources: Sequence[str], hot: DataFrame | None) -> DataFrame:
    """Rank columns of all queries, from ``valued_rows``; of several rows of a unit the best counts."""
    best = ["query", "source", "unit"]
    if hot is None:
        # one shuffle by query serves the aggregate, the windows and the columns
        whole = rows.repartition("query").groupBy(*best).agg(F.max("value").alias("value"))
        return _rank_columns(_ranks_in_one_task(whole), sources)
    hot = small_side(hot)
    usual = rows.join(hot, "query", "left_anti").repartition("query").groupBy(*best).agg(F.max("value").alias("value"))
    large = rows.join(hot, "query", "left_semi").groupBy(*best).agg(F.max("value").alias("value"))
    return _rank_columns(_ranks_in_one_task(usual), sources).unionByName(_rank_columns(_ranks_by_bucket(large), sources))


def correlation(columns: DataFrame, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and correlation matrix of the columns, from one pass of sums; the driver gets one row."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = columns.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c) for c in names], *[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]
    ).head()
    n, k = row[0], len(names)
    if not n:
        return np.zeros(k), np.zeros(k), np.eye(k)
    mean = np.array(row[1 : k + 1], dtype=float) / n
    cov = np.zeros((k, k))
    for (i, j), total in zip(pairs, row[k + 1 :], strict=True):
        cov[i, j] = cov[j, i] = total / n - mean[i] * mean[j]
    sd = np.sqrt(np.clip(np.diag(cov), 0, None))
    scale = np.where(sd > 1e-9, sd, 1.0)
    corr = cov / np.outer(scale, scale)
    np.fill_diagonal(corr, 1.0)
    return mean, sd, corr


def first_component(corr: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Loadings of the first principal component. The rank columns already rise with the declared direction, so a loading
    below zero is turned round; a column that is constant gets zero. If nothing correlates all columns weigh the same."""
    live = sd > 1e-9
    loadings = np.zeros(len(sd))
    if live.any():
        values, vectors = np.linalg.eigh(corr[np.ix_(live, live)])
        top = vectors[:, -1] if values[-1] > 1 + 1e-9 else np.ones(live.sum())
        loadings[live] = np.abs(top) / np.linalg.norm(top)
    return loadings


def fused_ranking(hits: DataFrame, query: str, source: str, unit: str, value: Column, top: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(query, unit, projection, position) of every unit, or of the first ``top`` of each query.

    Ties are broken by the unit's name. An empty table gives no rows."""
    rows = valued_rows(hits, query, source, unit, value)
    sources, hot = survey(rows, hot_rows)
    sources = sources or [""]
    names = [f"r{i}" for i in range(len(sources))]
    columns = checkpointed(rank_columns(rows, sources, hot))
    mean, sd, corr = correlation(columns, names)
    loadings = first_component(corr, sd)
    projection = F.lit(0.0)
    for name, mu, s, load in zip(names, mean, sd, loadings, strict=True):
        if load:
            projection = projection + (F.col(name) - float(mu)) * float(load / s)
    scored = columns.select(F.col("query").alias(query), F.col("unit").alias(unit), projection.alias("projection"))
    order = [F.round("projection", 9).desc(), F.col(unit)]
    if top is None:
        # a hot query's units are numbered range by range
        return row_numbers(scored, [query], order, "position", hot_rows, bound=columns.select(F.col("query").alias(query)))
    return scored.withColumn("position", F.row_number().over(Window.partitionBy(query).orderBy(*order))).where(F.col("position") <= top)
