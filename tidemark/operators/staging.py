"""Rows handed to the merge: the newest changes and the versions to re-insert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import BOOKKEEPING, JOIN_KEY, SCD_COLUMNS, MergeRules
from tidemark.functions.keys import ACTIVE, any_changed, columns_except, not_a_delete
from tidemark.operators.sizing import broadcast_if
from tidemark.operators.skew import join_on_key

MERGE_KEY = "mergeKey"
DEFAULT_RULES = MergeRules()

# A batch of at most this many keys looks for them by value.
POINT_KEYS = 64

# In a matched row the columns of the newest change carry this prefix.
NEW = "_s_"


def point_filter(newest: DataFrame, keys: int) -> Column | None:
    """The keys of a small batch, spelled out: files and row groups without them are not read.

    One equality per key, which Parquet tests against a row group's statistics, dictionary and Bloom filter;
    a longer list would reach it as a mere range. None for more than ``POINT_KEYS`` keys.
    """
    if keys > POINT_KEYS:
        return None
    tests = [F.col(JOIN_KEY) == F.lit(r[0]) for r in newest.select(JOIN_KEY).collect()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def versions_of(
    newest: DataFrame, target: DataFrame, small: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """All table versions of the keys in ``newest``."""
    keys = newest.select(F.col(JOIN_KEY).alias("_n_key"))
    return join_on_key(target, keys, "_n_key", "left_semi", small, hot)


def versions_of_other_keys(
    newest: DataFrame, target: DataFrame, small: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    keys = newest.select(F.col(JOIN_KEY).alias("_n_key"))
    return join_on_key(target, keys, "_n_key", "left_anti", small, hot)


def match_versions(
    target: DataFrame,
    newest: DataFrame,
    how: str = "inner",
    small: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Table versions next to the newest change of their key (``_s_`` columns).

    ``newest`` has one row per key, so no version can match twice.
    """
    right = newest.toDF(*[NEW + c for c in newest.columns])
    return join_on_key(target, right, NEW + JOIN_KEY, how, small, hot)


def changed_among(
    matched: DataFrame,
    newest_columns: Sequence[str],
    scd_cols: Sequence[str],
    rules: MergeRules = DEFAULT_RULES,
) -> DataFrame:
    """Newest rows of matched versions that are active and differ in a versioned column."""
    changed = any_changed(scd_cols, "", NEW, rules.null_safe)
    rows = matched.where(f"{ACTIVE} AND {changed}").selectExpr(
        *[f"`{NEW}{c}` AS `{c}`" for c in newest_columns]
    )
    return rows.where(not_a_delete()) if rules.honor_deletes else rows


def changed_keys(
    newest: DataFrame,
    target: DataFrame,
    scd_cols: Sequence[str],
    rules: MergeRules = DEFAULT_RULES,
    small: bool = False,
) -> DataFrame:
    """Newest rows whose key has an active version with different versioned columns."""
    matched = match_versions(target.where(ACTIVE), newest, "inner", small)
    return changed_among(matched, newest.columns, scd_cols, rules)


def reopened_among(
    newest: DataFrame,
    versions: DataFrame,
    rules: MergeRules = DEFAULT_RULES,
    small: bool = False,
) -> DataFrame:
    """Newest rows of keys all of whose ``versions`` are closed.

    ``versions`` has no keys beyond those of ``newest`` when ``small`` is set.
    """
    state = versions.groupBy(F.col(JOIN_KEY).alias("_t_key")).agg(
        F.expr(f"coalesce(bool_or({ACTIVE}), false)").alias("_open")
    )
    rows = newest.join(
        broadcast_if(state.where("NOT _open"), small),
        F.col(JOIN_KEY) == F.col("_t_key"),
        "left_semi",
    )
    return rows.where(not_a_delete()) if rules.honor_deletes else rows


def stage(newest: DataFrame, again: DataFrame | None) -> DataFrame:
    """Re-inserts under a null merge key, then every newest row under its own key."""
    staged = newest.selectExpr(f"`{JOIN_KEY}` AS {MERGE_KEY}", "*")
    if again is None:
        return staged
    return again.selectExpr(f"CAST(NULL AS STRING) AS {MERGE_KEY}", "*").unionByName(staged)


def staged_updates(
    newest: DataFrame,
    target: DataFrame,
    scd_cols: Sequence[str],
    rules: MergeRules = DEFAULT_RULES,
    small: bool = False,
) -> DataFrame:
    """The staged rows for a whole table."""
    again = changed_keys(newest, target, scd_cols, rules, small) if scd_cols else None
    if rules.reopen:
        closed = reopened_among(newest, versions_of(newest, target, small), rules, small)
        again = closed if again is None else again.unionByName(closed)
    return stage(newest, again)


def insert_values(row_columns: Sequence[str]) -> dict[str, str]:
    """What a newly inserted version holds, as SQL text per table column."""
    payload = columns_except(row_columns, [*BOOKKEEPING, *SCD_COLUMNS, MERGE_KEY])
    return {c: f"`{c}`" for c in payload} | {
        "ActiveIndicator": "true",
        "EffectiveDate": "ds",
        "EndDate": "NULL",
        "Action": "op_type",
    }


def bucket_of(key: str, buckets: int) -> str:
    """Bucket of a key, as SQL text."""
    return f"pmod(hash({key}), {buckets})"
