import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import (
    any_changed,
    business_key,
    columns_except,
    drop_bookkeeping,
    history_columns,
    key_first,
    overwrite_columns,
    with_business_key,
)
from tidemark.functions.naming import (
    base_name,
    base_name_column,
    flat_name,
    history_name,
    quoted,
    scd2_name,
)


def test_key_has_no_separator_and_null_is_empty(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (None, 7), (None, None)], "a INT, b INT")
    keys = [r[0] for r in df.select(business_key(["a", "b"])).collect()]
    assert keys == ["123", "123", "7", ""]
    assert [r[0] for r in df.select(business_key(["a", "b"], "|")).collect()] == ["1|23", "12|3", "|7", "|"]


def test_column_sets(spark):
    df = with_business_key(
        spark.createDataFrame([(1, 2, 3, "u", "s")], "id INT, price INT, name INT, op_type STRING, scn STRING"),
        ["id"],
    )
    assert columns_except(["a", "B", "b"], ["b"]) == ["a", "B"]
    assert key_first(df).columns[0] == "JoinKey"
    assert drop_bookkeeping(df).columns == ["id", "price", "name", "JoinKey"]
    assert overwrite_columns(df.columns, ["price"], ["id"]) == ["name"]
    # the partition date is a column overwritten in place
    assert overwrite_columns(["id", "day", "day_PARTITION", "ds"], [], ["id"]) == ["day", "day_PARTITION"]
    # the operation code decides about history, other bookkeeping does not
    assert history_columns(df.columns) == ["id", "price", "name", "op_type"]


def test_change_predicate_ignores_nulls_unless_told(spark):
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), (None, "b"), ("a", None), (None, None)], "x STRING, n_x STRING"
    )
    plain = df.selectExpr(f"coalesce({any_changed(['x'], '', 'n_')}, false) AS c")
    safe = df.selectExpr(any_changed(["x"], "", "n_", null_safe=True) + " AS c")
    assert [r[0] for r in plain.collect()] == [False, True, False, False, False]
    assert [r[0] for r in safe.collect()] == [False, True, True, True, False]
    assert any_changed([], "", "n_") == "false"


@pytest.mark.parametrize(
    "topic, base",
    [
        ("shop.dbo.ItemsT", "shop.ItemsT"),
        ("srv1.bank.holding", "srv1.holding"),
        ("a.b", "a.b"),
        ("shop-1", "shop_1"),
        ("a.b.c.d-e", "a.d_e"),
    ],
)
def test_table_names(spark, topic, base):
    assert base_name(topic) == base
    assert scd2_name(topic) == f"{base}_scd2"
    assert history_name(topic) == f"{base}_hist"
    assert flat_name(topic) == f"fso.{base}"
    assert spark.range(1).select(base_name_column(F.lit(topic))).first()[0] == base


def test_quoting():
    assert quoted("a.b`c") == "`a`.`b``c`"
