import pytest
from pyspark.sql import functions as F

from tidemark.operators.skew import hot_keys, join_on_key, versions_per_key


def table(spark):
    """A third of 3000 rows under one key, the rest with 20 rows per key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 100).cast("string"))
    return spark.range(3000).select(key.alias("JoinKey"), F.col("id").alias("v"))


def held(spark, keys=None):
    every = table(spark)
    newest = every.select("JoinKey").distinct()
    return versions_per_key(newest.where(keys) if keys else newest, every.withColumn("p", F.lit(1)), "p")


def test_hot_keys_and_their_pieces(spark):
    hot = hot_keys(held(spark), 300)
    assert [tuple(r) for r in hot.collect()] == [("hot", 4)]
    assert hot_keys(held(spark), 1001) is None
    assert hot_keys(held(spark), 10_000) is None


def test_only_keys_of_the_batch_can_be_hot(spark):
    assert hot_keys(held(spark, "JoinKey <> 'hot'"), 300) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    target = table(spark)
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("nowhere", 3)], "k STRING, n INT")
    plain = join_on_key(target, right, "k", how)
    salted = join_on_key(target, right, "k", how, hot=hot_keys(held(spark), 300))
    assert salted.columns == plain.columns
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_hot_rows_reach_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.createDataFrame([("hot", 1)], "k STRING, n INT")
        target = table(spark)
        hot = hot_keys(held(spark), 100)

        def tasks(df):
            return df.select(F.spark_partition_id()).distinct().count()

        assert tasks(join_on_key(target, right, "k", "inner")) == 1
        assert tasks(join_on_key(target, right, "k", "inner", hot=hot)) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
