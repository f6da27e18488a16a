"""Filling fixed-capacity containers with items: sum-of-squares packing.

An item goes to the fill level that minimises the sum of squared counts of partially filled containers, which are
tracked in an array over the levels. The documents are spread over independent shards; what a shard leaves open is packed
again, container by container, in rounds over fewer shards, so that little space stays unused in total."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.tokens import FOLDER, NAME, byte_bpe
from folioflow.session import checkpointed

CAPACITY = 8192
#: Tokens that one shard takes, and items, whose sizes one task holds: more shards, not fewer items, where either is more.
SHARD_TOKENS, SHARD_ITEMS = 16_000_000, 200_000
#: A container is packed again in the next round if it is less full than this.
FULL = 0.98


class SumOfSquares:
    """Open containers by fill level. Every decision looks at the counts only, so it takes the same time at any size."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.fill: list[int] = []

    def place(self, size: int) -> int:
        """The container that an item of 1 to ``capacity`` tokens goes into."""
        c, counts = self.capacity, self.counts
        level, least = 0, 2 * int(counts[size]) + 1 if size < c else 0
        if size < c:
            # moving a container from level h to h + size changes the sum by 2 (N[h + size] - N[h] + 1); a full one is no longer counted
            levels = np.flatnonzero(counts[: c - size + 1])
            if len(levels):
                change = 2 * (counts[levels + size] - counts[levels]) + 2
                if levels[-1] == c - size:
                    change[-1] = 1 - 2 * counts[c - size]
                # of equal levels the fullest
                best = len(change) - 1 - int(np.argmin(change[::-1]))
                if change[best] <= least:
                    level = int(levels[best])
        if level:
            box = self.at[level].pop()
            counts[level] -= 1
        else:
            box = len(self.fill)
            self.fill.append(0)
        level += size
        self.fill[box] = level
        if level < c:
            self.at[level].append(box)
            counts[level] += 1
        return box


def _pack_shard(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container of each item and fill of each container; the items are taken in the order given."""
    packer = SumOfSquares(capacity)
    boxes = np.fromiter((packer.place(int(s)) for s in sizes), dtype=np.int64, count=len(sizes))
    return boxes, np.array(packer.fill, dtype=np.int64)


def document_tokens(documents: DataFrame, key: str, text: str, folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """(key, n_tokens) of every document under a public tokenizer; NULL texts have 0. No shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = byte_bpe(folder, name)
        for batch in batches:
            sizes = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch["_text"].tolist()]
            yield pd.DataFrame({"_key": batch["_key"], "n_tokens": np.array(sizes, dtype=np.int64)})

    picked = documents.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return picked.mapInPandas(count, "_key string, n_tokens bigint").select(F.col("_key").cast(documents.schema[key].dataType).alias(key), "n_tokens")


def pack_sizes(sizes: DataFrame, key: str, capacity: int = CAPACITY, shards: int = 8, fan_in: int = 8) -> DataFrame:
    """(key, piece_no, first_token, n_tokens, container_id, container_fill) of all items.

    An item beyond the capacity is cut into pieces of the capacity and a rest; no other item is cut. Items of size 0 or
    NULL take no space: their container is NULL. Equal keys are items of their own. The result depends on keys and sizes only
    as far as ties go: every container keeps within the capacity and every item is placed once."""
    kind = sizes.schema[key].dataType
    n = F.coalesce(F.col("n_tokens"), F.lit(0))
    pieces = sizes.select(
        F.col(key).cast("string").alias("_key"),
        F.explode(F.when(n > capacity, F.sequence(F.lit(0), F.floor((n - 1) / capacity).cast("int"))).otherwise(F.array(F.lit(0)))).alias("piece_no"),
        n.cast("bigint").alias("_n"),
    ).select("_key", "piece_no", F.least(F.col("_n") - F.col("piece_no") * capacity, F.lit(capacity)).cast("int").alias("n_tokens"))
    shard = F.pmod(F.xxhash64("_key", "piece_no"), F.lit(shards)).cast("int")
    schema = "_key string, piece_no int, n_tokens int, container bigint, fill int, shard int"

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_key", "piece_no"], kind="stable")
        real = frame["n_tokens"].to_numpy() > 0
        boxes, fill = _pack_shard(frame["n_tokens"].to_numpy()[real], capacity)
        own = int(frame["shard"].iloc[0])
        container = np.full(len(frame), -1, dtype=np.int64)
        container[real] = boxes * shards + own
        full = np.zeros(len(frame), dtype=np.int32)
        full[real] = fill[boxes]
        return frame.assign(container=container, fill=full)[["_key", "piece_no", "n_tokens", "container", "fill", "shard"]]

    first = checkpointed(pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(pack, schema))
    moved = _merge_open(first.where(F.col("fill").between(1, int(capacity * FULL) - 1)), capacity, shards, fan_in)
    # both sides grow with the items, so the join is never a broadcast
    placed = first.join(moved.hint("merge"), "container", "left") if moved is not None else first.withColumn("target", F.lit(None).cast("bigint")).withColumn("target_fill", F.lit(None).cast("int"))
    return placed.select(
        F.col("_key").cast(kind).alias(key),
        "piece_no",
        (F.col("piece_no") * capacity).cast("int").alias("first_token"),
        "n_tokens",
        F.when(F.col("n_tokens") > 0, F.coalesce("target", "container")).alias("container_id"),
        F.when(F.col("n_tokens") > 0, F.coalesce("target_fill", "fill")).alias("container_fill"),
    )


def _merge_open(rows: DataFrame, capacity: int, shards: int, fan_in: int) -> DataFrame | None:
    """(container, target, target_fill): open containers put together whole, as items of the same packing, in rounds over
    ever fewer shards until one is left. A round's input are the containers that the one before left open: a few for each fill level and shard."""
    moved = None
    opened = rows.groupBy("container").agg(F.max("fill").alias("fill"), F.max("shard").alias("shard"))
    opened = opened.withColumn("members", F.array("container"))
    groups = shards
    schema = "container bigint, fill int, shard int, members array<bigint>"

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["fill", "container"], ascending=[False, True], kind="stable")
        boxes, fill = _pack_shard(frame["fill"].to_numpy(), capacity)
        out = []
        for box, part in frame.groupby(boxes):
            out.append((int(part["container"].iloc[0]), int(fill[box]), int(part["shard"].iloc[0]), [int(m) for ms in part["members"] for m in ms]))
        return pd.DataFrame(out, columns=["container", "fill", "shard", "members"])

    done = []
    while groups > 1:
        groups = -(-groups // fan_in)
        step = opened.withColumn("shard", F.pmod(F.col("shard"), F.lit(groups)).cast("int")).groupBy("shard").applyInPandas(merge, schema)
        step = checkpointed(step)
        done.append(step.where(F.col("fill") >= int(capacity * FULL)) if groups > 1 else step)
        opened = step.where(F.col("fill") < int(capacity * FULL))
    for part in done:
        part = part.select(F.explode("members").alias("m"), F.col("container").alias("target"), F.col("fill").alias("target_fill")).withColumnRenamed("m", "container")
        moved = part if moved is None else moved.unionByName(part)
    return moved


def shard_count(items: int, tokens: int) -> int:
    return max(1, -(-tokens // SHARD_TOKENS), -(-items // SHARD_ITEMS))


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, folder: str = FOLDER, name: str = NAME) -> DataFrame:
    """All documents in containers of ``capacity`` tokens; see ``pack_sizes``. The texts are read once; the number of shards follows the tokens and the documents."""
    sizes = checkpointed(document_tokens(documents, key, text, folder, name))
    items, tokens = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).head()
    return pack_sizes(sizes, key, capacity, shard_count(items, tokens))
