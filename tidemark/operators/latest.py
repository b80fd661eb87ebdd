"""Newest change per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import JOIN_KEY
from tidemark.functions.keys import columns_except

_RANK = "_latest_rank"


def latest_per_key(
    batch: DataFrame,
    order_cols: Sequence[str],
    key: Sequence[str] = (JOIN_KEY,),
    time_col: str | None = "ds",
) -> DataFrame:
    """One row per key: the greatest ``(time_col, *order_cols)``, nulls last.

    ``row_number() = 1`` lets Spark put a group limit below the shuffle, so each
    map task sends at most one row per key, however hot the key is. Columns
    beyond ``order_cols`` break remaining ties, which keeps re-runs identical.
    """
    if not order_cols and time_col is None:
        raise ValueError("latest_per_key needs an order")
    leading = [c for c in ([time_col] if time_col else []) + list(order_cols)]
    orderable = {
        f.name for f in batch.schema.fields if "map<" not in f.dataType.simpleString()
    }
    rest = [c for c in columns_except(batch.columns, [*leading, *key]) if c in orderable]
    window = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in leading + rest])
    return (
        batch.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )
