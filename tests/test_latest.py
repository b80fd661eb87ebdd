import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemark.operators.latest import latest_per_key


def picked(df):
    return sorted(tuple(r) for r in df.select("id", "price").collect())


def test_newest_date_then_order_column_nulls_last(spark):
    df = rows(
        spark,
        (1, "old", "n", "u", 1, 9),
        (1, "new", "n", "u", 2, 1),
        (2, "tie-low", "n", "u", 1, 1),
        (2, "tie-high", "n", "u", 1, 2),
        (3, "undated", "n", "u", None, 9),
        (3, "dated", "n", "u", 1, 1),
    )
    assert picked(latest_per_key(df, ["_offset"])) == [(1, "new"), (2, "tie-high"), (3, "dated")]


def test_full_ties_are_still_decided(spark):
    df = rows(spark, (1, "a", "n", "u", 1, 5), (1, "b", "n", "u", 1, 5), (1, "c", "n", "u", 1, 5))
    for _ in range(3):
        assert picked(latest_per_key(df.repartition(3), ["_offset"])) == [(1, "c")]


def test_an_order_is_required(spark):
    with pytest.raises(ValueError):
        latest_per_key(rows(spark, (1, "a", "n", "u", 1)), [], time_col=None)


def test_hot_key_is_cut_down_before_the_shuffle(spark, plan_of):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("JoinKey"),
        F.lit("2024-01-01").cast("date").alias("ds"),
        F.col("id").alias("_offset"),
    )
    newest = latest_per_key(hot, ["_offset"])
    text = plan_of(newest, "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert newest.where("JoinKey = 'hot'").first()["_offset"] == 29_997
    assert newest.count() == 20_001
