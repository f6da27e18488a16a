"""Exact vector search of a stated set of queries over all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are searched for at once: their vectors are sent to every executor.
QUERY_BLOCK = 4096
TOP_K = 20


def _unit_rows(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 and which of them are usable."""
    matrix = np.array(vectors, dtype=np.float64)
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    good = lengths > 0
    return matrix / np.where(good, lengths, 1.0)[:, None], good


def _nearest_rows(found: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` smallest of each column, to nine digits, ties by key."""
    if len(found) <= k:
        row, column = np.indices(found.shape)
        return row.ravel(), column.ravel()
    near = np.round(found, 9)
    inside = near <= np.partition(near, k - 1, axis=0)[k - 1]
    for j in np.flatnonzero(inside.sum(axis=0) > k):
        tied = np.flatnonzero(inside[:, j])
        inside[tied[np.lexsort((keys[tied], near[tied, j]))[k:]], j] = False
    return np.nonzero(inside)


def nearest(content: DataFrame, queries: DataFrame, k: int = TOP_K, unit: str = "unit", vector: str = "vector", query: str = "query") -> DataFrame:
    """(query, unit, distance, rank): the ``k`` units nearest to each query by cosine distance, ties by unit.

    Both sides have (id, vector). Vectors that are NULL, empty, zero or of another length than the query's have no distance.
    The queries come in blocks of ``QUERY_BLOCK``; every task keeps its own ``k`` best of each query, so that only
    those are shuffled. No index: the result is exact."""
    kinds = f"{query} {dict(queries.dtypes)[query]}, {unit} {dict(content.dtypes)[unit]}, distance double"
    result, block = None, []
    source = queries.where((F.size(vector) > 0) & F.col(query).isNotNull()).select(query, vector)
    rows = source.toLocalIterator()

    def search(block: list) -> DataFrame:
        ids = [r[0] for r in block]
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(block):
            by_size.setdefault(len(r[1]), []).append(i)
        groups = []
        for size, members in by_size.items():
            matrix, good = _unit_rows([block[i][1] for i in members])
            groups.append((size, [ids[i] for i, g in zip(members, good, strict=True) if g], matrix[good]))
        sent = content.sparkSession.sparkContext.broadcast(groups)

        def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sizes = batch[vector].map(len).to_numpy()
                for size, names, matrix in sent.value:
                    own = batch[sizes == size]
                    if not len(own) or not names:
                        continue
                    units, good = _unit_rows(own[vector].tolist())
                    keys = own[unit].to_numpy()[good]
                    for low in range(0, len(names), 256):
                        part = names[low : low + 256]
                        found = 1.0 - units[good] @ matrix[low : low + 256].T
                        row, column = _nearest_rows(found, keys, k)
                        yield pd.DataFrame({query: np.array(part)[column], unit: keys[row], "distance": found[row, column]})

        return content.where((F.size(vector) > 0) & F.col(unit).isNotNull()).select(unit, vector).mapInPandas(local, kinds)

    for row in rows:
        block.append(row)
        if len(block) == QUERY_BLOCK:
            part, block = search(block), []
            result = part if result is None else result.unionByName(part)
    part = search(block)
    result = part if result is None else result.unionByName(part)
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.round("distance", 9), unit))
    return result.withColumn("rank", rank).where(F.col("rank") <= k)
