"""Canonical forms of paths and digests."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _composed(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None else unicodedata.normalize("NFC", v))


def canonical_path(path: Column) -> Column:
    """``/`` as the only separator, never two in a row, no white space at the ends, Unicode form NFC.

    Characters below U+0300 are their own NFC form, so only other paths are sent to Python."""
    plain = F.regexp_replace(F.regexp_replace(path, r"(?U)^\s+|\s+$", ""), r"[\\/]+", "/")
    plain = F.regexp_replace(plain, r"(?U)^\s+|\s+$", "")
    needs = plain.rlike(r"[^\x{0000}-\x{02FF}]")
    return F.when(needs, _composed(F.when(needs, plain))).otherwise(plain)


def canonical_digest(digest: Column) -> Column:
    """The 64 hexadecimal digits in lower case; NULL if there are none."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(digest)), "([0-9a-f]{64})$", 1), F.lit(""))
