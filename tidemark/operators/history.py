"""Insert-if-absent for the history table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import broadcast_if


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _equal(left: DataFrame, right: DataFrame, columns: Sequence[str], null_safe: bool) -> Column:
    pairs = [(left[c], right[f"_h_{c}"]) for c in columns]
    tests = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, tests)


def unseen_rows(
    batch: DataFrame,
    history: DataFrame,
    compare: Sequence[str],
    null_safe: bool = False,
    small: bool = False,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Batch rows with no equal history row; duplicates inside the batch all stay.

    By default a row with a null in any compared column equals nothing, so such
    rows skip the join (they would otherwise pile up on one null-heavy key).

    ``small``: the batch was measured and may be broadcast; history is then only
    scanned, never shuffled. Otherwise both sides are reduced to distinct
    compared values before the shuffle, so a value repeated a billion times
    travels once per map task, and ``cut`` materialises the matches so that the
    last join reads plain shuffles, which AQE can split when the batch is skewed.
    """
    aliased = [F.col(c).alias(f"_h_{c}") for c in compare]
    comparable = batch if null_safe else batch.where(_all_present(compare))
    wanted = comparable.select(*compare).distinct()
    known = history.select(*aliased)
    if not small:
        known = known.distinct()
    seen = known.join(
        broadcast_if(wanted, small), _equal(wanted, known, compare, null_safe), "left_semi"
    )
    seen = seen.distinct() if small else cut(seen)
    fresh = comparable.join(
        broadcast_if(seen, small), _equal(comparable, seen, compare, null_safe), "left_anti"
    )
    if null_safe:
        return fresh
    return fresh.unionByName(batch.where(~_all_present(compare)))
