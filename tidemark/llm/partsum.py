"""Fixed-size tables of counts, summed over all tasks in a tree of bounded groups."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import kept
from tidemark.llm.textops import give_back

FAN_IN = 16
PART_SCHEMA = "part long, sums binary"


def packed(table: np.ndarray) -> bytes:
    """Compressed; by the filled cells alone where they are few, in four bytes a cell where they do."""
    filled = np.flatnonzero(table)
    if len(filled) * 8 < len(table):
        return b"s" + zlib.compress(np.concatenate((filled, table[filled])).astype(np.int64).tobytes(), 1)
    if np.iinfo(np.int32).min <= table.min() and table.max() <= np.iinfo(np.int32).max:
        return b"i" + zlib.compress(np.ascontiguousarray(table, dtype=np.int32), 1)
    return b"d" + zlib.compress(np.ascontiguousarray(table, dtype=np.int64), 1)


def add_to(total: np.ndarray, raw: bytes) -> None:
    """Add a packed table to ``total`` in place."""
    values = np.frombuffer(zlib.decompress(raw[1:]), dtype=np.int32 if raw[:1] == b"i" else np.int64)
    if raw[:1] in b"di":
        total += values
    else:
        half = len(values) // 2
        total[values[:half]] += values[half:]


def part_number() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def part_batch(table: np.ndarray) -> pa.RecordBatch:
    """One task's table, as a row of ``PART_SCHEMA``."""
    return pa.RecordBatch.from_arrays(
        [pa.array([part_number()], pa.int64()), pa.array([packed(table)], pa.binary())], ["part", "sums"]
    )


def _adder(cells: int):
    def added(frame: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(cells, dtype=np.int64)
        for raw in frame["sums"]:
            add_to(sums, raw)
        give_back()
        return pd.DataFrame({"part": [int(frame["part"].min()) // FAN_IN], "sums": [packed(sums)]})

    return added


def total(parts: DataFrame, cells: int) -> np.ndarray:
    """The sum of all parts; what reaches the driver is one table of ``cells`` numbers."""
    widest = parts.agg(F.max("part")).first()[0]
    while widest:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group"))
        parts = kept(grouped.applyInPandas(_adder(cells), PART_SCHEMA), "partsum")
        widest //= FAN_IN
    sums = np.zeros(cells, dtype=np.int64)
    for (raw,) in parts.select("sums").collect():
        add_to(sums, raw)
    return sums
