import random

import numpy as np

from folioflow.llm import leakage as lk

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "ta") for b in ("bra", "del", "fon", "gus", "hel", "jor", "kin", "lam", "mer", "nop")]


def item(rng, n=90):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(99)) if rng.random() < 0.2 else "") for _ in range(n))


def cases(seed=4):
    rng = random.Random(seed)
    items = [(i, item(rng)) for i in range(30)]
    docs, want = [], set()
    for k in range(200):
        noise = ["the", "net", "margin", "rose", "by", "a", "share", "of", "loans"]
        filler = lambda n: " ".join(rng.choice(noise) + ("" if rng.random() < 0.5 else str(rng.randrange(9))) for _ in range(n))
        i, text = rng.choice(items)
        w = text.split()
        share = rng.choice([0, 0.15, 0.25, 0.5, 0.7, 1])
        n = int(len(w) * share)
        start = rng.randrange(len(w) - n + 1)
        quote = w[start : start + n]
        for p in range(11, len(quote), 17):  # a word in 17 changed
            quote[p] = "changed"
        shape = rng.randrange(5)
        body = " ".join(quote)
        if shape == 1:
            body = body.upper().replace(" ", "  \n")
        elif shape == 2:
            body = "| " + body.replace(" ", " | ") + " |"
        elif shape == 3:
            body = "<b>" + body.replace("a", "​a") + "</b>"
        elif shape == 4 and n > 40:
            half = len(quote) // 2
            body = " ".join(quote[:half]) + ". " + filler(30) + " " + " ".join(quote[half:])
        docs.append((k, f"{filler(40)} {body} {filler(20)}"))
        if share >= 0.5:
            want.add((k, i))
    return docs, items, want


def test_planted(spark):
    docs, items, want = cases()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in lk.leaked_items(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == want


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items, want = cases(5)
    monkeypatch.setattr(lk, "ITEM_BLOCK", 7)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in lk.leaked_items(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == want


def test_lookup_finds_all_within_the_radius():
    rng = random.Random(1)
    passages = lk.ItemIndex([(i, item(rng)) for i in range(20)]).passages[0]
    assert passages.size == lk.WINDOW
    flips = [sum(1 << b for b in rng.sample(range(64), rng.randrange(lk.RADIUS + 3))) for _ in passages.prints[::7]]
    prints = np.array([int(p) ^ f for p, f in zip(passages.prints[::7], flips, strict=True)], dtype=np.uint64)
    got = {pair for q, p in passages.within_radius(prints) for pair in zip(q.tolist(), p.tolist(), strict=True)}
    want = {(q, p) for q in range(len(prints)) for p in range(len(passages.prints)) if int(prints[q] ^ passages.prints[p]).bit_count() <= lk.RADIUS}
    assert got == want


def test_fingerprints_do_not_depend_on_the_other_items():
    rng = random.Random(8)
    items = [(i, item(rng)) for i in range(40)]
    alone, among = lk.ItemIndex(items[:5]).passages[0], lk.ItemIndex(items).passages[0]
    assert (alone.prints == among.prints[: len(alone.prints)]).all()


def test_similarity_against_brute_force():
    rng = np.random.default_rng(3)
    left, right = rng.integers(-1, 9, (50, 6)), rng.integers(0, 9, (50, 6))
    lw, rw = rng.random((50, 6)), rng.random((50, 6))
    got = lk.similarity(left, lw, right, rw)
    for k in range(50):
        one = sum(w for x, w in zip(left[k], lw[k], strict=True) if x in set(right[k].tolist())) / lw[k].sum()
        two = sum(w for x, w in zip(right[k], rw[k], strict=True) if x in set(left[k].tolist())) / rw[k].sum()
        assert abs(got[k] - min(one, two)) < 1e-9


def test_words():
    assert lk.words("Re-graded &ldquo;A&rdquo; <b>x</b>|1,234.5­​ ﬂoor “q”") == [b"regraded", b"a", b"x", b"12345", b"floor", b"q"]


def test_edges(spark):
    rng = random.Random(2)
    long_item = item(rng)
    items = spark.createDataFrame([(None, long_item), (2, None), (3, ""), (4, "two words")], "item_id bigint, text string")
    rows = [(None, long_item, "x"), (2**60 + 1, long_item, "x"), (3, None, "x"), (4, "", "x"), (5, "two words", "x"), (6, "filler " * 200_000 + long_item, "x"), (7, "words two", "x")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, item_id string")
    got = lk.leaked_items(d, items).collect()
    assert sorted(((str(r["doc_id"]), r["item_id"]) for r in got), key=str) == sorted([("None", None), (str(2**60 + 1), None), ("6", None), ("5", 4)], key=str)
    assert lk.leaked_items(d, items.limit(0)).count() == 0
    assert lk.leaked_items(d.limit(0), items).count() == 0


def test_a_word_in_six_changed_added_or_dropped(spark):
    rng = random.Random(6)
    items = [(i, item(rng)) for i in range(30)]
    rows, want = [], set()
    for k in range(60):
        i, text = items[k % 30]
        quote = text.split()
        for p in range(len(quote) - 4, 0, -6):
            quote[p : p + 1] = ([], ["changed"], [quote[p], "added"])[k % 3]
        half = len(quote) // 2 if k % 2 else len(quote)  # the second half far off
        rows.append((k, " ".join([*quote[:half], *(["filler"] * 500), *quote[half:]])))
        want.add((k, i))
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["share"] for r in lk.leaked_items(d, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert set(got) == want
    assert min(got.values()) > 0.8


def test_recall_of_edited_passages():
    """Every item, whole and in part, with each 4th to 8th word changed, added or dropped."""
    rng = random.Random(9)
    items = [(i, item(rng)) for i in range(40)]
    index = lk.ItemIndex(items)
    for every in (4, 6, 7, 8):
        for kind in range(3):
            for share in (1.0, 0.5):
                texts = []
                for _, text in items:
                    quote = text.split()
                    quote = quote[: int(len(quote) * share)]
                    for p in range(len(quote) - 1 - rng.randrange(3), 0, -every):
                        quote[p : p + 1] = ([], ["changed"], [quote[p], "added"])[kind]
                    texts.append(" ".join([*["filler"] * 50, *quote, *["more"] * 50]))
                found = {(k, i) for k, i in ((k, i) for k, i, _ in index.shares(texts)) if k == i}
                assert len(found) >= 0.95 * len(items)
