"""Ordered merge clauses as one join, one CASE and one anti join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import JOIN_KEY, KEY_BUCKET, MergeRules
from tidemark.functions.keys import ACTIVE, any_changed, delete_event, not_a_delete
from tidemark.operators.sizing import broadcast_if
from tidemark.operators.staging import (
    DEFAULT_RULES,
    MERGE_KEY,
    NEW,
    bucket_of,
    insert_values,
    match_versions,
    versions_of,
)

# Clause numbers reported in the tag column.
UNTOUCHED, CLOSED_CHANGED, CLOSED_DELETED, OVERWRITTEN, INSERTED, REMOVED = 0, 1, 2, 3, 4, 5
CLAUSE = "_clause"
ORIGIN = "_origin"


def clause_number(scd_cols: Sequence[str], upd_cols: Sequence[str], rules: MergeRules) -> str:
    """CASE giving the first clause that holds; an unknown condition does not hold."""
    whens = [f"WHEN `{NEW}{JOIN_KEY}` IS NULL THEN {UNTOUCHED}"]
    if scd_cols:
        changed = any_changed(scd_cols, "", NEW, rules.null_safe)
        whens.append(f"WHEN {ACTIVE} AND {changed} THEN {CLOSED_CHANGED}")
    whens.append(f"WHEN {ACTIVE} AND {delete_event(NEW + 'op_type')} THEN {CLOSED_DELETED}")
    if upd_cols:
        changed = any_changed(upd_cols, "", NEW, rules.null_safe)
        only = f"{ACTIVE} AND " if rules.active_only_overwrite else ""
        whens.append(f"WHEN {only}{changed} THEN {OVERWRITTEN}")
    return f"CASE {' '.join(whens)} ELSE {UNTOUCHED} END"


def apply_clauses(
    matched: DataFrame,
    columns: Sequence[tuple[str, str]],
    scd_cols: Sequence[str],
    upd_cols: Sequence[str],
    rules: MergeRules = DEFAULT_RULES,
    origin: str | None = None,
) -> DataFrame:
    """Matched versions after the merge, tagged with the clause that took them.

    ``columns``: (name, type) pairs of the table. ``origin`` adds that column's
    value from before the merge.
    """
    closing = f"{CLAUSE} IN ({CLOSED_CHANGED}, {CLOSED_DELETED})"
    overwriting = f"{CLAUSE} = {OVERWRITTEN}"
    new_values = {c: (overwriting, f"`{NEW}{c}`") for c in upd_cols}
    new_values["ActiveIndicator"] = (closing, "false")
    new_values["EndDate"] = (closing, f"`{NEW}ds`")
    new_values["Action"] = (closing, f"`{NEW}op_type`")

    def after(name: str, kind: str) -> str:
        if name not in new_values:
            return f"`{name}`"
        when, value = new_values[name]
        return f"CASE WHEN {when} THEN CAST({value} AS {kind}) ELSE `{name}` END AS `{name}`"

    before = [f"`{origin}` AS {ORIGIN}"] if origin else []
    return matched.withColumn(CLAUSE, F.expr(clause_number(scd_cols, upd_cols, rules))).selectExpr(
        *[after(name, kind) for name, kind in columns], CLAUSE, *before
    )


def inserted_rows(
    staged: DataFrame,
    present: DataFrame,
    target_schema: T.StructType,
    rules: MergeRules = DEFAULT_RULES,
    small: bool = False,
    key_buckets: int = 0,
) -> DataFrame:
    """Staged rows whose merge key is not in ``present``, as new active versions.

    ``present`` has all table versions of the staged keys. With ``small`` it has
    no other keys, so its distinct keys may be broadcast as well.

    Null merge keys match nothing; keeping them out of the join also keeps them
    from meeting in one shuffle partition.
    """
    known = present.select(F.col(JOIN_KEY).alias("_t_key")).distinct()
    unmatched = staged.where(f"{MERGE_KEY} IS NOT NULL").join(
        broadcast_if(known, small), F.col(MERGE_KEY) == F.col("_t_key"), "left_anti"
    )
    if rules.honor_deletes:
        unmatched = unmatched.where(not_a_delete())
    fresh = staged.where(f"{MERGE_KEY} IS NULL").unionByName(unmatched)
    values = insert_values(staged.columns)
    if key_buckets:
        values[KEY_BUCKET] = bucket_of(f"`{JOIN_KEY}`", key_buckets)
    return fresh.selectExpr(
        *[
            f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in target_schema.fields
        ],
        f"{INSERTED} AS {CLAUSE}",
    )


def merge(
    target: DataFrame,
    staged: DataFrame,
    scd_cols: Sequence[str],
    upd_cols: Sequence[str],
    rules: MergeRules = DEFAULT_RULES,
    small: bool = False,
) -> DataFrame:
    """The table after the merge. Which clauses exist follows from the column lists.

    versioned + overwrite columns: close changed, close deleted, overwrite, insert;
    versioned only: close changed, close deleted, insert;
    overwrite only: close deleted, overwrite, insert; neither: nothing happens.
    """
    if not scd_cols and not upd_cols:
        return target
    keyed = staged.where(f"{MERGE_KEY} IS NOT NULL")
    matched = match_versions(target, keyed, "left", small)
    updated = apply_clauses(matched, target.dtypes, scd_cols, upd_cols, rules)
    present = versions_of(keyed, target, small) if small else target
    inserts = inserted_rows(staged, present, target.schema, rules, small)
    return updated.unionByName(inserts).drop(CLAUSE)

