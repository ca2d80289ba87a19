"""The hot-key-safe helpers equal plain window functions, also when one key
holds most of the rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyfold.operators.ranking import number_rows, prefix_sum, prior_value


def _frame(spark):
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 5), i, rnd.randint(0, 9), rnd.randint(1, 4)) for i in range(600)]
    return spark.createDataFrame(rows, "k int, t int, day int, v int")


def test_prefix_sum_equals_window(spark):
    df = _frame(spark)
    w = Window.partitionBy("k").orderBy("day", "t").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    # buckets must follow the order: order by (day, t) on both sides
    got = prefix_sum(df, ["k"], ["day", "t"], "v", F.col("day"), "s")
    assert sorted(got.select("t", "s").collect()) == sorted(want.select("t", "s").collect())


def test_prior_value_equals_lag(spark):
    df = _frame(spark).withColumn("label", F.concat(F.lit("x"), F.col("t").cast("string")))
    got = prior_value(df, ["k"], ["day", "t"], "label", F.col("day"), "prev")
    want = df.withColumn("prev", F.lag("label").over(Window.partitionBy("k").orderBy("day", "t")))
    assert sorted(got.select("t", "prev").collect()) == sorted(want.select("t", "prev").collect())


def test_number_rows_equals_row_number(spark):
    df = _frame(spark)
    got = number_rows(df, ["k"], ["v", "t"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "t")))
    assert sorted(got.select("t", "n").collect()) == sorted(want.select("t", "n").collect())


def test_number_rows_equals_row_number_on_many_rows(spark):
    df = spark.range(0, 1_000_000, 1, 12).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("v"), "id")
    got = number_rows(df, ["k"], ["v", "id"], "n")
    want = df.withColumn("m", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
    assert got.join(want, "id").where("n != m").count() == 0


def test_number_rows_ranges_only_large_keys(spark):
    rows = [(k, i, i % 3) for k, n in (("a", 40), ("b", 7), ("c", 1), (None, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    want = df.where("k is not null").withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "t")))
    for most in (0, 7, 1000):
        got = number_rows(df, ["k"], ["v", "t"], "n", most)
        assert got.columns == want.columns
        assert sorted(got.collect()) == sorted(want.collect())
    plan = number_rows(df, ["k"], ["v", "t"], "n")._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan      # no key is large: one window, nothing ranged or checkpointed


def test_sums_of_large_and_other_keys_equal_those_by_bucket(spark):
    from skyfold.operators.ranking import large_keys, prefix_sum, prefix_sum_by_size
    rows = [(k, None if i % 11 == 0 else i // 3, i, None if i % 7 == 0 else i % 5, i % 4) for k in (1, 2, None) for i in range(30 if k == 1 else 9)]
    df = spark.createDataFrame(rows, "k int, day int, id int, v int, w int")
    key, order, bucket = ["k"], ["day", "id"], F.col("day")
    want = sorted(map(tuple, prefix_sum(df, key, order, ["v", "w"], bucket, ["a", "b"]).collect()), key=str)
    for most in (100, 10, 0):
        large = large_keys(df.where("k is not null"), key, most)
        assert (large is None) == (most == 100)
        assert sorted(map(tuple, prefix_sum_by_size(df, key, order, ["v", "w"], bucket, ["a", "b"], large).collect()), key=str) == want
