from pyspark.sql import functions as F

from usagetide.functions.skew import hot_keys, join_split_hot


def test_hot_rows_are_split_and_kept(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    dimension = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = hot_keys(rows, "k", 50).collect()
    assert [(r["k"], r["ways"]) for r in hot] == [(1, 6)]
    want = {tuple(r) for r in rows.join(dimension, "k").collect()}
    got = join_split_hot(rows, dimension, "k", "id", 50).collect()
    assert {tuple(r) for r in got} == want and len(got) == 400


def test_key_without_a_dimension_row_is_left_out(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, k string")
    dimension = spark.createDataFrame([("a", 5)], "k string, v int")
    got = join_split_hot(rows, dimension, "k", "id", 1).collect()
    assert sorted(r["id"] for r in got) == [1, 2]


def test_hot_keys_are_few_whatever_the_limit(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert len(hot_keys(rows, "k", 1, most=10).collect()) < 10
    assert hot_keys(rows.where("k < 0"), "k", 1).count() == 0
