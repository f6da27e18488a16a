import pytest
from pyspark.sql import functions as F

from folioflow.operators import content


def test_pieces_over_the_limit_are_split_again(spark):
    text = "# a\nw w\n# b\n" + "\n".join(["w w w"] * 10)
    pages = spark.createDataFrame([(1, text), (2, "w " * 4 + "\n" + "w " * 5), (3, None)], "k int, t string")
    rows = content.chunks_within(pages, ["k"], "t", limit=8).orderBy("k", "chunk_no").collect()
    assert all(r["token_count"] <= 8 for r in rows)
    assert "\n".join(r["chunk_text"] for r in rows if r["k"] == 1) == text
    assert [r["token_count"] for r in rows if r["k"] == 2] == [4, 5]
    assert [r["chunk_no"] for r in rows if r["k"] == 1] == list(range(1, 1 + sum(r["k"] == 1 for r in rows)))


def test_a_line_over_the_limit_is_an_error(spark):
    pages = spark.createDataFrame([("w " * 9,)], "t string")
    with pytest.raises(Exception, match="over the limit of 8 after 2 retries"):
        content.chunks_within(pages, [], "t", limit=8).collect()


def test_regions_and_previews(spark):
    regions = [("chart", True), ("Legend", True), ("table", False), ("photo", None), (None, True)]
    df = spark.createDataFrame([(regions,)], "r array<struct<region_type: string, requires_region_extraction: boolean>>")
    assert [r[0] for r in df.select(content.regions_to_extract(F.col("r"))).head()[0]] == ["chart", None]
    assert content.preview_sizes(120) == [120, 60, 40] and content.preview_sizes(60) == [60, 40] and content.preview_sizes(40) == [40, 60]
    texts = spark.createDataFrame([("x" * 9,), ("x" * 8,)], "t string").select(content.preview(F.col("t"), 2)).collect()
    assert [r[0] for r in texts] == ["x" * 8 + "...", "x" * 8]
