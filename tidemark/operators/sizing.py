"""Measured sizes: nothing is broadcast on a guess."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def within(self, limit: int) -> bool:
        return self.bytes <= limit


def _row_bytes(df: DataFrame) -> Column:
    """Eight bytes per column plus the variable-length part."""
    total = F.lit(8 * (len(df.columns) + 1)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = F.to_json(F.struct(F.col(f.name)))
            total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total


def measure(df: DataFrame) -> Size:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return Size(row["n"], row["b"] or 0)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for a side whose measured size allows it; otherwise AQE decides."""
    return F.broadcast(df) if small else df
