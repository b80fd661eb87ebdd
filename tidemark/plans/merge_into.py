"""The same clauses through Spark's own MERGE, for table formats that support it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import JOIN_KEY, MergeRules
from tidemark.functions.keys import ACTIVE, any_changed, delete_event, not_a_delete, prefixed
from tidemark.operators.staging import MERGE_KEY, insert_values
from tidemark.sources.tables import TableRef

# Formats whose tables accept MERGE.
MERGE_FORMATS = ("delta", "iceberg")
_SOURCE = "staged_updates"


def supports_merge(table: TableRef) -> bool:
    return table.format in MERGE_FORMATS


def merge_into(
    staged: DataFrame,
    table: TableRef,
    scd_cols: Sequence[str],
    upd_cols: Sequence[str],
    rules: MergeRules,
) -> None:
    old, new = f"`{table.name.split('.')[-1]}`.", f"{_SOURCE}."
    active = f"{old}{ACTIVE}"
    op_type = prefixed(new, "op_type")
    close = {
        "ActiveIndicator": F.lit(False),
        "EndDate": F.expr(prefixed(new, "ds")),
        "Action": F.expr(op_type),
    }
    insert = {c: F.expr(v) for c, v in insert_values(staged.columns).items()}

    writer = staged.alias(_SOURCE).mergeInto(
        table.sql_name, F.expr(f"{prefixed(old, JOIN_KEY)} = {prefixed(new, MERGE_KEY)}")
    )
    if scd_cols:
        changed = any_changed(scd_cols, old, new, rules.null_safe)
        writer = writer.whenMatched(F.expr(f"{active} AND {changed}")).update(close)
    writer = writer.whenMatched(F.expr(f"{active} AND {delete_event(op_type)}")).update(close)
    if upd_cols:
        changed = any_changed(upd_cols, old, new, rules.null_safe)
        only = f"{active} AND " if rules.active_only_overwrite else ""
        writer = writer.whenMatched(F.expr(only + changed)).update(
            {c: F.expr(prefixed(new, c)) for c in upd_cols}
        )
    if rules.honor_deletes:
        writer = writer.whenNotMatched(F.expr(not_a_delete(op_type))).insert(insert)
    else:
        writer = writer.whenNotMatched().insert(insert)
    writer.merge()
