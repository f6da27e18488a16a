import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import splitting as sp


@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.data())
def test_sparse_table(values, data):
    low = data.draw(st.integers(0, len(values) - 1))
    high = data.draw(st.integers(low, len(values) - 1))
    best = max(range(low, high + 1), key=lambda i: (values[i], i))
    assert sp.SparseTable(np.array(values)).rightmost_maximum(low, high) == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "bb.", "c,", "\n", "\n\n", "# H\n", "| r |\n", "\r\n", "\t", "é"]), max_size=80), st.integers(3, 12), st.integers(0, 2))
def test_pieces(parts, limit, overlap):
    text = " ".join(parts)
    words = [w for w in text.replace("\r", " ").replace("\n", " ").replace("\t", " ").split(" ") if w]
    pieces = sp.split_text(text, limit, overlap, overlap + 1)
    if not words:
        assert pieces == []
        return
    assert pieces[0][0] == 0 and pieces[-1][0] + pieces[-1][1] == len(words)
    for first, n, start, end in pieces:
        assert 1 <= n <= limit
        assert text[start:end].split() == words[first : first + n]
    for (a, n, *_), (b, *_) in zip(pieces, pieces[1:], strict=False):
        assert b == a + n - overlap


def test_cuts_where_the_boundary_is_strongest():
    text = "a b c.\nd e f\n\ng h i\n# H\nj k l"
    assert [text[s:e] for _, _, s, e in sp.split_text(text, 9, 0, 2)] == ["a b c.\nd e f\n\ng h i", "# H\nj k l"]
    assert [n for _, n, *_ in sp.split_text("x " * 10, 4, 1, 2)] == [4, 4, 4]


def test_operator(spark):
    long_text = " ".join(f"w{i}" for i in range(9000))
    rows = [(1, long_text, "head one", 1), (2, "short", None, 1), (3, None, None, 1), (4, "w " * 8192, "", 1), (5, "w " * 8192, "h", 1), (None, long_text, None, 1), (7, "x", "h " * 9000, 1), (8, "", "", 1), (9, "w" * 100_000, None, 1)]
    df = spark.createDataFrame(rows, "id bigint, raw_content string, chunk_header string, piece_no int")
    got = sp.split_oversized(df, "id", "raw_content", "chunk_header").collect()
    assert {r["id"] for r in got} == {1, 5, 7, None}
    for r in got:
        assert len(r["piece"].split()) <= sp.LIMIT and r["header_tokens"] + r["n_tokens"] <= sp.LIMIT
    assert all(r["piece"].startswith("head one\n") for r in got if r["id"] == 1)
    assert sp.split_oversized(df.limit(0), "id", "raw_content").count() == 0
