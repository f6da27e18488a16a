import random

from pyspark.sql import functions as F

from folioflow.operators.ranks import row_numbers


def test_hot_groups_get_the_same_numbers(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([1.0, 2.0, None]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, v double, i int")
    order = [F.col("v").desc_nulls_last(), F.col("i")]
    a = sorted(map(str, row_numbers(df, ["g"], order, "n").collect()))
    b = sorted(map(str, row_numbers(df, ["g"], order, "n", hot_rows=100).collect()))
    assert a == b
    assert row_numbers(df.limit(0), ["g"], order, "n").count() == 0
