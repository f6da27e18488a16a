"""Model calls behind small interfaces, with deterministic offline defaults."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.schemas import PROVIDER_ANSWERS, struct


class Provider(Protocol):
    """Answers a prompt of a stage with JSON in the stage's schema."""

    def call(self, stage: str, prompt: str) -> str: ...


class Offline:
    """Answers without a model: headings are sections and breakpoints, frequent words are keywords, nothing is removed."""

    def call(self, stage: str, prompt: str) -> str:
        counts = Counter(re.findall(r"[A-Za-z][A-Za-z0-9]{3,}", prompt))
        often = sorted(counts, key=lambda w: (-counts[w], w))[:5]
        names = list(dict.fromkeys(re.findall(r"\b[A-Z][a-z]+(?: [A-Z][a-z]+)+\b", prompt)))[:4]
        lines = prompt.splitlines()
        heads = [i + 1 for i, x in enumerate(lines) if x.startswith("#")]
        answers: dict[str, dict[str, Any]] = {
            "markdown_chunking": {"breakpoints": heads},
            "xlsx_chunking": {"breakpoints": [], "sheet_passthrough_rows": [], "section_passthrough_rows": []},
            "section_detection": {"sections": [{"title": lines[h - 1].lstrip("# "), "start_page": 1} for h in heads[:1]], "rationale": ""},
            "query_prep": {"rewritten_query": " ".join(prompt.split()), "sub_queries": [], "keywords": often, "entities": names, "hyde_answer": ""},
            "rerank": {"remove_indices": []},
            "research": {"findings": [], "additional_queries": [], "confidence": 1.0},
            "doc_summary": {"executive_summary": " ".join(prompt.split()[:60]), "keywords": often, "entities": names, "rationale": ""},
            "doc_metadata": {"title": lines[0].lstrip("# ") if lines else "", "authors": "", "publication_date": "", "language": "en", "structure_type": "sections", "has_toc": False, "toc_entries": [], "rationale": ""},
        }
        return json.dumps(answers.get(stage, {"content": prompt}))


def prompt_book(path: str) -> dict[str, dict[str, str]]:
    """Prompts by stage from a JSON or, where the library is there, a YAML file: each with the texts ``system`` and ``user`` and, optionally, the ``fields`` that its
    values fill (``{name}``). A prompt of an unknown stage, without a text, or with a place that is none of its fields is an error."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            book = yaml.safe_load(f)
        else:
            book = json.load(f)
    for stage, prompt in book.items():
        places = set(re.findall(r"\{(\w+)\}", prompt.get("user", "")))
        if stage not in PROVIDER_ANSWERS or not prompt.get("system") or not prompt.get("user") or places - set(prompt.get("fields", places)):
            raise ValueError(f"prompt of {stage!r}")
    return book


def rendered(prompt: str, values: Mapping[str, Column]) -> Column:
    """A prompt with its places (``{name}``) filled; NULLs are blank. Values are not searched for places."""
    parts = re.split(r"\{(\w+)\}", prompt)
    return F.concat(*[F.lit(p) if k % 2 == 0 else F.coalesce(values[p].cast("string"), F.lit("")) for k, p in enumerate(parts)])


def with_retry(call: Callable[[], Any], attempts: int = 3, pause: float = 1.0, retry: tuple[type[Exception], ...] = (ValueError, OSError)) -> Any:
    """The call's result; on the given errors it is made again after a pause that grows by the same amount each time."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except retry:
            if attempt == attempts:
                raise
            time.sleep(pause * attempt)
    raise AssertionError


def answers(rows: DataFrame, prompt: str, stage: str, provider: Callable[[], Provider] = Offline) -> DataFrame:
    """Rows with ``answer`` in the stage's schema. Every distinct prompt is asked once; an answer that is no JSON of the schema fails the job."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = provider()
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "_json": [with_retry(lambda p=p: own.call(stage, p)) for p in batch["_prompt"]]})

    keyed = rows.withColumn("_key", F.sha2(F.coalesce(F.col(prompt), F.lit("")), 256))
    once = keyed.groupBy("_key").agg(F.first(F.coalesce(F.col(prompt), F.lit(""))).alias("_prompt"))
    said = once.mapInPandas(ask, "_key string, _json string")
    return keyed.join(said, "_key", "left").withColumn("answer", parsed_answer(F.col("_json"), stage)).drop("_key", "_json")


def parsed_answer(text: Column, stage: str) -> Column:
    return F.from_json(text, struct(PROVIDER_ANSWERS[stage]), {"mode": "FAILFAST"})


def valid_items(items: Column, key: str) -> Column:
    """Whether an answer's items all have a key and none twice."""
    keys = F.transform(items, lambda x: x[key])
    return (F.size(items) > 0) & F.forall(keys, lambda k: F.coalesce(k, F.lit("")) != "") & (F.size(F.array_distinct(keys)) == F.size(keys))


def hash_embedding(texts: pd.Series, size: int = 64) -> pd.Series:
    """A vector for each text from its words' hashes, of length 1; blank texts have none."""
    def vector(text: str | None) -> list[float] | None:
        total = np.zeros(size)
        for word in re.findall(r"\w+", (text or "").lower()):
            h = int.from_bytes(hashlib.md5(word.encode(), usedforsecurity=False).digest()[:8], "big")
            total[h % size] += 1.0 if h >> 63 else -1.0
        length = float(np.sqrt((total * total).sum()))
        return (total / length).tolist() if length else None

    return texts.map(vector)


def embedded(rows: DataFrame, text: str, size: int = 64, into: str = "vector") -> DataFrame:
    from pyspark.sql.types import ArrayType, FloatType

    function = F.pandas_udf(lambda s: hash_embedding(s, size), ArrayType(FloatType()))
    return rows.withColumn(into, function(F.col(text)))
