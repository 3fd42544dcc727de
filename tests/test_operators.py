"""Spread operators against the plain Spark form, on skewed tables."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import bag
from orefold.operators.joins import left_lookup, orphans, repeated_keys, rows_not_in, rows_used
from orefold.operators.ordering import latest_per_key, lead_within, number_rows, number_within
from orefold.operators.skew import split_hot


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has key 7, a third of those are copies; some keys are NULL."""
    i = F.col("id")
    return spark.range(0, 3000, 1, 6).select(
        F.when(i % 3 == 0, 7).when(i % 11 == 0, None).otherwise(i % 50 + 100).cast("int").alias("k"),
        F.when(i % 9 == 0, 5).otherwise((i * 7919) % 400).cast("int").alias("v"),
        F.when(i % 9 == 0, "copy").when(i % 5 == 0, None).otherwise(F.concat(F.lit("t"), (i % 13).cast("string"))).alias("t"),
    )


def window(keys):
    return W.partitionBy(*keys).orderBy(F.col("v").desc(), F.col("t"))


def test_number_rows_is_dense_and_ordered(spark, skewed):
    plain = skewed.withColumn("n", F.row_number().over(W.orderBy("k", F.col("v").desc(), "t")).cast("bigint"))
    assert bag(number_rows(skewed, ["k", "-v"], "n")) == bag(plain)


def test_number_rows_uses_many_partitions(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(skewed.where("k = 7 and t = 'copy'"), ["k"], "n")
        assert len(numbered.inputFiles()) > 1
        assert sorted(r.n for r in numbered.collect()) == list(range(1, numbered.count() + 1))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_number_rows_of_nothing(spark, skewed):
    assert number_rows(skewed.where("false"), ["k"], "n").count() == 0


def test_split_hot(spark, skewed, hot):
    spark.conf.set("spark.orefold.hotGroupRows", "500")
    cold, busy = split_hot(skewed, ["k"])
    assert {r.k for r in busy.select("k").distinct().collect()} == {7}
    assert cold.count() + busy.count() == 3000


@pytest.mark.parametrize("rows", [3000, 500, 30, 0])
def test_number_within(spark, skewed, hot, rows):
    spark.conf.set("spark.orefold.hotGroupRows", str(rows))
    plain = skewed.withColumn("n", F.row_number().over(window(["k"])))
    assert bag(number_within(skewed, ["k"], ["-v"], "n")) == bag(plain)


@pytest.mark.parametrize("rows", [3000, 500, 30, 0])
def test_lead_within(spark, skewed, hot, rows):
    spark.conf.set("spark.orefold.hotGroupRows", str(rows))
    plain = skewed.withColumn("next", F.lead("v").over(window(["k"])))
    assert bag(lead_within(skewed, ["k"], ["-v"], "v", "next")) == bag(plain)


def test_latest_per_key(spark, skewed):
    plain = skewed.withColumn("n", F.row_number().over(window(["k"]))).where("n = 1")
    assert bag(latest_per_key(skewed, ["k"], ["-v"], "n")) == bag(plain)
    limited = latest_per_key(skewed, ["k"], ["-v"])
    assert limited._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize("list_bytes", ["0", "1000000"])
@pytest.mark.parametrize("rows", [5000, 50, 0])
def test_left_lookup(spark, hot, rows, list_bytes):
    spark.conf.set("spark.orefold.hotGroupRows", str(rows))
    spark.conf.set("spark.orefold.hotListBytes", list_bytes)
    i = F.col("id")
    left = spark.range(0, 60, 1, 4).select(
        F.when(i % 10 == 9, None).otherwise(i % 8).cast("int").alias("k"), i.alias("line")
    )
    right = spark.range(0, 600, 1, 5).select(
        F.when(i % 3 == 0, 2).when(i % 7 == 0, None).otherwise(i % 40).cast("int").alias("k"),
        F.when(i % 2 == 0, 0).otherwise(i).alias("w"),
    )
    named = right.withColumnRenamed("k", "rk")
    plain = left.join(named, F.col("k") == F.col("rk"), "left").drop("rk")
    assert bag(left_lookup(left, right, "k", "k")) == bag(plain)
    assert bag(left_lookup(left, named, "k", "rk")) == bag(plain)


def test_hot_right_key_in_one_partition_is_split(spark, hot):
    """Rows of one key that lie together still go to many parts."""
    spark.conf.set("spark.orefold.hotGroupRows", "50")
    left = spark.range(0, 40).select((F.col("id") % 2).alias("k"), F.col("id").alias("line"))
    right = spark.range(0, 1000, 1, 1).select(F.lit(1).cast("bigint").alias("k"), F.col("id").alias("w"))
    named = right.withColumnRenamed("k", "rk")
    plain = left.join(named, F.col("k") == F.col("rk"), "left").drop("rk")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = left_lookup(left, right, "k", "k")
        assert bag(found) == bag(plain)
        busy = found.where("w IS NOT NULL").groupBy(F.spark_partition_id()).count()
        assert busy.count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_left_lookup_broadcasts_only_below_the_bound(spark):
    big = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("w"))
    left = spark.range(10).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in left_lookup(left, big, "k", "k")._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.orefold.broadcastBytes", "15999")
        assert "Broadcast" not in left_lookup(left, big, "k", "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.orefold.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_lookup_refuses_shared_columns(spark):
    df = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    with pytest.raises(ValueError):
        left_lookup(df, df, "k", "k")


@pytest.mark.parametrize("listed", [[], ["a"], ["a", None], [None], ["a", "a", "b"]])
def test_rows_not_in(spark, listed):
    df = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    ids = spark.createDataFrame([(x,) for x in listed], "id string")
    df.createOrReplaceTempView("probe")
    ids.createOrReplaceTempView("listed")
    plain = spark.sql("SELECT * FROM probe WHERE k NOT IN (SELECT id FROM listed)")
    assert bag(rows_not_in(df, "k", ids, "id")) == bag(plain)


def test_rows_used_and_orphans(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    users = spark.createDataFrame([(1,), (1,), (3,), (None,)], "u int")
    assert bag(rows_used(df, "k", users, "u")) == {(1,): 2}
    assert bag(orphans(df, "k", users, "u")) == {(2,): 1, (None,): 1}


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert bag(repeated_keys(df, "k", "n")) == {(1, 2): 1}
    assert bag(repeated_keys(df, "k", "n", include_null=True)) == {(1, 2): 1, (None, 1): 1}
