"""Business key, column sets and the predicates used by the merges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import BOOKKEEPING, DELETE_OP, JOIN_KEY


def business_key(key_cols: Sequence[str], sep: str = "") -> Column:
    """Concatenated key parts, null as empty text.

    The cast comes first: under ANSI mode ``coalesce(int, '')`` fails on null.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    if sep:
        return F.concat_ws(sep, *parts)
    return F.concat(*parts)


def with_business_key(df: DataFrame, key_cols: Sequence[str], sep: str = "") -> DataFrame:
    return df.withColumn(JOIN_KEY, business_key(key_cols, sep))


def columns_except(columns: Iterable[str], unwanted: Iterable[str]) -> list[str]:
    """Order-keeping difference on exact names."""
    gone = set(unwanted)
    return [c for c in columns if c not in gone]


def drop_bookkeeping(df: DataFrame) -> DataFrame:
    return df.drop(*BOOKKEEPING)


def overwrite_columns(
    columns: Iterable[str],
    scd_cols: Iterable[str],
    key_cols: Iterable[str],
    transport: Iterable[str] = (),
) -> list[str]:
    """Columns updated in place: whatever is not key, versioned or bookkeeping."""
    return columns_except(columns, (*BOOKKEEPING, JOIN_KEY, *scd_cols, *key_cols, *transport))


def key_first(df: DataFrame) -> DataFrame:
    return df.select(JOIN_KEY, *columns_except(df.columns, [JOIN_KEY]))


# Predicates are SQL text: conditions over many columns stay one expression to
# build, and the same text serves joined frames and MERGE.

ACTIVE = "ActiveIndicator = true"


def any_changed(
    columns: Iterable[str], old: str, new: str, null_safe: bool = False
) -> str:
    """True when any column differs; by default a null on either side is no change.

    ``old`` and ``new`` are prefixes up to the column name, e.g. ``"t."`` and ``"s."``.
    """
    form = "NOT ({a} <=> {b})" if null_safe else "{a} <> {b}"
    tests = [
        form.format(a=prefixed(old, c), b=prefixed(new, c)) for c in columns if c != JOIN_KEY
    ]
    return "(" + " OR ".join(tests) + ")" if tests else "false"


def prefixed(prefix: str, column: str) -> str:
    """Quoted column behind a qualifier (``"t."``) or a name prefix (``"_s_"``)."""
    qualifier, dot, start = prefix.rpartition(".")
    return f"{qualifier}{dot}`{start}{column}`"


def delete_event(op_type: str = "op_type") -> str:
    """Lower-case code only; other spellings are ordinary changes."""
    return f"{op_type} = '{DELETE_OP}'"


def not_a_delete(op_type: str = "op_type") -> str:
    """True for null codes too."""
    return f"({op_type} IS NULL OR {op_type} <> '{DELETE_OP}')"


def history_columns(columns: Iterable[str], transport: Iterable[str] = ()) -> list[str]:
    """Columns that decide whether a row is already in history (``op_type`` counts)."""
    ignored = columns_except(BOOKKEEPING, ["op_type"])
    return columns_except(columns, (JOIN_KEY, *ignored, *transport))
