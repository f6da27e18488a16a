"""Quantities recorded in different units, converted to one common unit for each kind."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import small_side

FIELDS = ("metric_value", "unit", "metric_name", "location_detail", "finding")


def metric_head(name: Column) -> Column:
    """A metric's name up to what may be its unit: a bracket, or a comma, colon or dash and what follows it."""
    text = F.lower(F.coalesce(name, F.lit("")))
    return F.trim(F.regexp_replace(text, r"(?s)\s*(?:[(\[]|[,:\x{2013}\x{2014}]\s|\s-\s).*$", ""))


def first_bracket(name: Column) -> Column:
    """The bracket that follows a metric's head; '' if there is none."""
    return F.regexp_extract(F.coalesce(name, F.lit("")), r"^[^(\[,:\x{2013}\x{2014}]*([(\[][^()\[\]]*[)\]])", 1)


def metric_profiles(findings: DataFrame) -> DataFrame:
    """(head, own, stated): what the whole table tells of each metric: how often each dimension was stated as its unit, and the bracket that belongs to its name.

    Only distinct (head, bracket, unit) go to Python. A bracket belongs to the name if most of the metric's names have it, also where the unit stands elsewhere;
    one of very few names does not."""
    kinds = ("money", "ratio", "count", "duration")

    def state(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from folioflow.functions.unit_grammar import stated_dimension

        for batch in batches:
            yield batch[["head", "bracket", "n"]].assign(dimension=[stated_dimension(u) for u in batch["unit"].astype(object)])

    units = findings.groupBy(metric_head(F.col("metric_name")).alias("head"), first_bracket(F.col("metric_name")).alias("bracket"), F.coalesce("unit", F.lit("")).alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    said = units.mapInPandas(state, "head string, bracket string, n bigint, dimension string")
    brackets = said.groupBy("head", "bracket").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col("dimension") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds])
    elsewhere = sum((F.col(k) for k in kinds), F.lit(0)) > 0
    heads = brackets.groupBy("head").agg(
        F.sum("n").alias("n"), F.max(F.when((F.col("bracket") != "") & elsewhere, F.struct(F.col("n").alias("n"), F.col("bracket").alias("bracket")))).alias("top"), *[F.sum(k).alias(k) for k in kinds]
    )
    most = (F.col("top.n") + 1) / (F.col("n") + 4) > 0.5
    named = F.col("head") != ""
    return heads.select("head", F.when(most & named, F.col("top.bracket")).alias("own"), F.when(named, F.array(*kinds)).alias("stated"))


def common_units(findings: DataFrame, key: str = "finding_id") -> DataFrame:
    """(key, common_unit, amount) of each row whose value is one number with a known unit.

    The likelihoods of the dimensions of a metric are learned from the whole table first. NULL and empty fields state nothing; ranges, words and values without a unit give no row; equal rows give equal rows.
    Rows are not shuffled while there are few metrics; only the columns that are read go to Python, in Arrow batches."""
    schema = "_key string, common_unit string, amount bigint"

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from folioflow.functions.unit_grammar import common_amount, learned_prior

        priors: dict[tuple, tuple] = {}

        def amount(own, stated, value, unit, name, location, finding):
            prior = None
            if stated is not None:
                about = (name, tuple(stated))
                if about not in priors:
                    if len(priors) > 100_000:
                        priors.clear()
                    priors[about] = learned_prior(name, about[1])
                prior = priors[about]
            return common_amount(value, unit, name, location, finding, own, prior)

        for batch in batches:
            columns = [batch[c].astype(object).where(batch[c].notna(), None) for c in ("own", "stated", *FIELDS)]
            found = [amount(*row) for row in zip(*columns, strict=True)]
            keep = [i for i, f in enumerate(found) if f is not None]
            yield pd.DataFrame({"_key": batch["_key"].iloc[keep].array, "common_unit": [found[i][0] for i in keep], "amount": pd.array([found[i][1] for i in keep], dtype="int64")})

    # ids go to Python and back as text: pandas would turn a nullable integer into a float
    picked = findings.where(F.col("metric_value").isNotNull()).select(F.col(key).cast("string").alias("_key"), *FIELDS, metric_head(F.col("metric_name")).alias("head"))
    told = picked.join(small_side(metric_profiles(findings)), "head", "left").select("_key", "own", "stated", *FIELDS)
    return told.mapInPandas(convert, schema).select(F.col("_key").cast(findings.schema[key].dataType).alias(key), "common_unit", "amount")
