"""Lexical search: terms, Okapi BM25, containment in keyword arrays."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.operators.ranks import row_numbers
from folioflow.session import checkpointed, small_side

K1, B = 1.2, 0.75
TERM_CAP = 6
#: Queries that are searched for at once: their terms are sent to every executor.
QUERY_BLOCK = 4096
_TERM = re.compile("[a-z0-9]+")


def terms_of(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), 0)


def clean_term(term: Column) -> Column:
    spaced = F.regexp_replace(F.replace(term, F.lit("%"), F.lit(" percentage ")), "[^A-Za-z0-9]+", " ")
    return F.trim(F.regexp_replace(spaced, " +", " "))


def query_text(terms: Column, fallback: Column, cap: int = TERM_CAP) -> Column:
    """The terms without sign characters and repeats (whatever their case), phrases in quotes, joined by OR; the first ``cap``.
    Without any the fallback, as a phrase if it has several words."""
    cleaned = F.filter(F.transform(terms, clean_term), lambda t: t != "")
    first = F.filter(cleaned, lambda t, i: F.array_position(F.transform(cleaned, F.lower), F.lower(t)) == i + 1)

    def quoted(t: Column) -> Column:
        return F.when(F.contains(t, F.lit(" ")), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(t)

    joined = F.array_join(F.transform(F.slice(first, 1, cap), quoted), " OR ")
    rest = clean_term(fallback)
    return F.when(F.size(first) > 0, joined).when(rest == "", fallback).otherwise(quoted(rest))


def _term_counts(texts: DataFrame, unit: str, text: str, asked: dict[str, int]) -> DataFrame:
    """(unit, length, terms, times) of every text in one pass: its number of terms, and of those asked for the numbers and how often they stand in it."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [Counter(_TERM.findall(body.lower())) for body in batch["text"]]
            found = [[t for t in c if t in asked] for c in counts]
            yield pd.DataFrame({
                "unit": batch["unit"],
                "length": [c.total() for c in counts],
                "terms": [[asked[t] for t in ts] for ts in found],
                "times": [[c[t] for t in ts] for c, ts in zip(counts, found, strict=True)],
            })

    # ids go to Python and back as text: pandas would turn a nullable integer into a float
    picked = texts.where(F.col(unit).isNotNull()).select(F.col(unit).cast("string").alias("unit"), F.coalesce(text, F.lit("")).alias("text"))
    return picked.mapInPandas(cut, "unit string, length bigint, terms array<int>, times array<int>")


def _scored(texts: DataFrame, block: list[tuple], unit: str, text: str, k: int | None, k1: float, b: float) -> DataFrame:
    """(query_id, unit, score) as text and number of a block of (query id, terms); of each task's texts the ``k`` best of each query, and those equal to them."""
    asked = {t: n for n, t in enumerate(dict.fromkeys(t for _, terms in block for t in terms))}
    counts = checkpointed(_term_counts(texts, unit, text, asked))
    n, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).head()
    df = np.zeros(len(asked))
    # a row for each term of the block's queries
    for row in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        df[row["t"]] = row["df"]
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    pairs = sorted((asked[t], q) for q, (_, terms) in enumerate(block) for t in terms)
    owners = np.array([q for _, q in pairs], dtype=np.int64)
    first = np.searchsorted(np.array([t for t, _ in pairs], dtype=np.int64), np.arange(len(asked) + 1))
    sent = texts.sparkSession.sparkContext.broadcast(([i for i, _ in block], idf, owners, first, total / n if n else 1.0))  # at most QUERY_BLOCK queries

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, idf, owners, first, mean = sent.value
        names = np.array(names, dtype=object)
        for whole in batches:
            step = max(1, 4_000_000 // max(1, len(names)))
            for low in range(0, len(whole), step):
                batch = whole.iloc[low : low + step]
                sizes = batch["terms"].map(len).to_numpy()
                if not sizes.sum():
                    continue
                row = np.repeat(np.arange(len(batch)), sizes)
                term, times = np.concatenate(batch["terms"].tolist()), np.concatenate(batch["times"].tolist()).astype(float)
                part = idf[term] * times * (k1 + 1) / (times + k1 * (1 - b + b * batch["length"].to_numpy()[row] / mean))
                fan = first[term + 1] - first[term]
                at = np.repeat(first[term], fan) + np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
                scores = np.bincount(np.repeat(row, fan) * len(names) + owners[at], np.repeat(part, fan), minlength=len(batch) * len(names)).reshape(len(batch), -1)
                kept = scores > 0
                if k is not None and len(batch) > k:
                    shown = np.round(scores, 9)
                    kept &= shown >= np.partition(shown, len(batch) - k, axis=0)[len(batch) - k]
                i, q = np.nonzero(kept)
                yield pd.DataFrame({"query_id": names[q], "unit": batch["unit"].to_numpy()[i], "score": scores[i, q]})

    return counts.mapInPandas(score, "query_id string, unit string, score double")


def bm25(texts: DataFrame, queries: DataFrame, unit: str, text: str, k: int | None = 20, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, unit, score, rank): Okapi BM25 of each query's distinct terms; ``queries`` has (query_id, terms).

    Queries come in blocks of ``QUERY_BLOCK``, for each of which the texts are read once; what is kept of a text are the counts of the terms asked for. Every task
    keeps its own best of each query, so that only those move. Length and number of texts are taken over all of them. NULL ids are left out; no terms give no rows."""
    rows = queries.where(F.col("query_id").isNotNull()).select(F.col("query_id").cast("string"), F.array_distinct("terms").alias("terms")).toLocalIterator()
    result = None
    while (block := [(r[0], r[1] or []) for r in islice(rows, QUERY_BLOCK)]) or result is None:
        part = _scored(texts, block, unit, text, k, k1, b)
        result = part if result is None else result.unionByName(part)
    scored = result.select(F.col("query_id").cast(queries.schema["query_id"].dataType), F.col("unit").cast(texts.schema[unit].dataType), "score")
    order = [F.round("score", 9).desc(), F.col("unit")]
    if k is None:
        return row_numbers(scored, ["query_id"], order, "rank").withColumnRenamed("unit", unit)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).withColumnRenamed("unit", unit)


def contains_any(rows: DataFrame, array: str, wanted: Sequence[str], key: Sequence[str], k: int | None = None) -> DataFrame:
    """Rows of which an element has one of the texts in it, in any case (``%`` and ``_`` are wildcards), with the number of distinct
    texts found; most first. An empty list, a NULL or empty array give no rows."""

    def has(text: str) -> Column:
        return F.exists(F.coalesce(array, F.array().cast("array<string>")), lambda e: F.coalesce(e.ilike(f"%{text}%"), F.lit(False))).cast("int")

    found = sum((has(text) for text in dict.fromkeys(wanted)), F.lit(0))
    hits = rows.withColumn("n_matched", found).where("n_matched > 0").select(*key, "n_matched")
    return hits if k is None else hits.orderBy(F.col("n_matched").desc(), *key).limit(k)


def contains_all(rows: DataFrame, array: str, wanted: Sequence[str]) -> DataFrame:
    """Rows whose array has every one of the texts, exactly."""
    return rows.where(F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), F.coalesce(array, F.array().cast("array<string>")))) == 0)


def alternatives(query: Column) -> Column:
    """A query's alternatives (``a OR "b c"``), each as its terms with a space around every one; those without terms are left out."""
    padded = F.transform(F.split(query, r"\s+OR\s+"), lambda q: F.concat(F.lit(" "), F.array_join(terms_of(q), " "), F.lit(" ")))
    return F.array_distinct(F.filter(padded, lambda q: F.trim(q) != ""))


def text_matches(texts: DataFrame, queries: DataFrame, unit: str, text: str) -> DataFrame:
    """(query_id, unit, n_matched): of a stated set of queries (query_id, query_text) the texts in which an alternative's terms stand side by side in
    its order, and how many of the alternatives do. NULL and empty texts match nothing."""
    asked = queries.select("query_id", alternatives(F.col("query_text")).alias("_asked")).where(F.size("_asked") > 0)
    own = texts.select(F.col(unit).alias("unit"), F.concat(F.lit(" "), F.array_join(terms_of(F.col(text)), " "), F.lit(" ")).alias("_own"))
    found = F.size(F.filter("_asked", lambda q: F.contains(F.col("_own"), q)))
    # a stated query set against all rows
    return own.join(small_side(asked)).select("query_id", F.col("unit").alias(unit), found.alias("n_matched")).where("n_matched > 0")
