import random
from collections import Counter

import pytest

from folioflow.llm import packing

SIZES = "k bigint, n_tokens bigint, shard int"


def packed(spark, sizes, capacity=100, shards=4, fan_in=2):
    df = spark.createDataFrame([(i, n, 0) for i, n in enumerate(sizes)], SIZES)
    return packing.pack_sizes(df, "k", capacity, shards, fan_in).collect()


@pytest.mark.parametrize("shards", [1, 5])
def test_packing(spark, shards):
    rng = random.Random(1)
    sizes = [rng.choice([0, 1, 7, 33, 50, 99, 100, 101, 250]) for _ in range(600)]
    rows = packed(spark, sizes, shards=shards)
    totals, whole = Counter(), Counter()
    for r in rows:
        whole[r["k"]] += r["n_tokens"]
        assert (r["container_id"] is None) == (r["n_tokens"] == 0)
        assert r["first_token"] == 100 * r["piece_no"]
        if r["n_tokens"]:
            totals[r["container_id"]] += r["n_tokens"]
        if sizes[r["k"]] <= 100:
            assert r["piece_no"] == 0 and r["n_tokens"] == sizes[r["k"]]
    assert dict(whole) == {i: n for i, n in enumerate(sizes)}
    assert max(totals.values()) <= 100
    assert all(totals[r["container_id"]] == r["container_fill"] for r in rows if r["n_tokens"])
    assert sum(totals.values()) / (100 * len(totals)) > 0.97


def test_choice_minimises_the_sum_of_squares():
    rng = random.Random(2)
    packer = packing.SumOfSquares(20)
    for _ in range(300):
        size = rng.randrange(1, 21)
        before = packer.counts.copy()

        def cost(level, size=size, before=before):
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 20:
                after[level + size] += 1
            return int((after[:20] ** 2).sum())

        options = [0, *[h for h in range(1, 21 - size) if before[h]]]
        packer.place(size)
        assert int((packer.counts[:20] ** 2).sum()) == min(cost(h) for h in options)


def test_edges(spark):
    assert packed(spark, []) == []
    null = spark.createDataFrame([(None, None, 1), (None, 5, 1), (2**60 + 1, 5, 1)], SIZES)
    rows = packing.pack_sizes(null, "k", 10, 2).collect()
    assert sorted((str(r["k"]), r["n_tokens"]) for r in rows) == [(str(2**60 + 1), 5), ("None", 0), ("None", 5)]


def test_documents(spark):
    try:
        packing.byte_bpe()
    except OSError:
        pytest.skip("no tokenizer")
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "word " * 20_000), (5, "<|endoftext|>")], "doc_id bigint, text string")
    rows = packing.pack_documents(df).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5}
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 4) > 20_000 and max(r["n_tokens"] for r in rows) == 8192
