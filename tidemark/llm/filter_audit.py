"""Filter interaction audit: five filters in every order, by contractions of per-part contingency tensors.

A document fails
  A  with under 100 words,
  B  if 100 * distinct words < 80 * words,
  C  if 100 * capitals (A-Z) > 10 * code points,
  D  if it holds any of # $ % & * |,
  E  if its text is that of a smaller doc_id anywhere in the table, removed or not.
Words are maximal runs of other than white space, compared as they are.

Documents of one part (language) are counted by which filters they fail: 2^5 cells, for all of them, for
those labelled good and for those labelled toxic. The 32 counts are reshaped to 2x2x2x2x2, an axis per
filter, and for every order and step ``einsum`` selects pass, fail or all along each axis. Nothing but the
counts is collected, and no document is read again for another order.

What the text alone decides is found per row. For E, rows are first counted by text and id, then by text,
part and labels, so that a text of a third of all rows is a few rows before its first id is looked for.

Null texts are empty: they fail A, and E beside a smaller id with an empty text. A null language is the
part ''. Rows without doc_id pass E and have no label. Repeated rows count each; rows of one id are no
copies of each other. Of several labels of an id the largest counts. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents, kept

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
COUNTS = ("n", "good", "toxic")
_SPACE = r"[\x20\x09-\x0D]+"
_SIGNS = r"[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Selectors of an axis of length two: documents that pass, that fail, or both.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _bit(letter: str) -> int:
    """Weight of a filter in a cell's number; A is the slowest axis."""
    return 1 << (len(FILTERS) - 1 - FILTERS.index(letter))


def own_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and the failures A to D as a cell number."""
    plain = documents(docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")), "part")
    words = plain.withColumn("words", F.filter(F.split("text", _SPACE), lambda w: w != ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length("text") - F.length(F.translate("text", _CAPITALS, ""))
    tests = {
        "A": n < 100,
        "B": 100 * distinct.cast("long") < 80 * n.cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.length("text").cast("long"),
        "D": F.col("text").rlike(_SIGNS),
    }
    cell = sum((F.when(test, _bit(k)).otherwise(0) for k, test in tests.items()), F.lit(0))
    return words.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), cell.alias("cell"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, cell, n, good, toxic: documents of each part by the filters they fail."""
    # A row per text, id and part: copies of a row travel once per map task.
    rows = kept(own_failures(docs).groupBy("doc_id", "part", "digest", "cell").agg(F.count(F.lit(1)).alias("k")), "audit-rows")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("t"))
        .where("label_id IS NOT NULL")
        .groupBy("label_id")
        .agg(F.max("q").alias("q"), F.max("t").alias("t"))
    )
    known = rows.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
    # Rows without an id meet no label; in the join they would all be one key.
    loose = rows.where("doc_id IS NULL").withColumns({"q": F.lit(None).cast("int"), "t": F.lit(None).cast("int")})
    marked = known.unionByName(loose).withColumns({c: F.coalesce(F.col(c) == 1, F.lit(False)).cast("long") for c in "qt"})
    groups = marked.groupBy("digest", "part", "cell", "q", "t").agg(
        F.sum("k").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("k"))), F.lit(0)).alias("loose"),
        # The group's first id and its rows; labels are the id's own, so no id is in two such groups of a part.
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "k"))).alias("lead"),
    )
    first = F.min("lead.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("loose") + F.when(F.col("lead.doc_id") == first, F.col("lead.k")).otherwise(0)
    both = groups.withColumn("passing", passing).select(
        "part", "q", "t",
        F.explode(F.array(
            F.struct(F.col("cell"), F.col("passing").alias("n")),
            F.struct((F.col("cell") + _bit("E")).alias("cell"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("c"),
    )
    n = F.col("c.n")
    return both.groupBy("part", F.col("c.cell").alias("cell")).agg(
        F.sum(n).alias("n"), F.sum(n * F.col("q")).alias("good"), F.sum(n * F.col("t")).alias("toxic")
    )


def _steps() -> list[tuple[str, int, str]]:
    """(order, step from 1, its filter) of every permutation."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    return [(order, k + 1, letter) for order in orders for k, letter in enumerate(order)]


def _selectors(choose) -> np.ndarray:
    """A selector per step and axis; ``choose(order, step, letter of the axis)``."""
    return np.array([[choose(order, step, axis) for axis in FILTERS] for order, step, _ in _steps()], dtype=np.int64)


def contract(tensor: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """Sums of (measure, a, b, c, d, e) over the chosen cells: a row per step, a column per measure."""
    axes = [selectors[:, k] for k in range(len(FILTERS))]
    return np.einsum("mabcde,sa,sb,sc,sd,se->sm", tensor, *axes, optimize=["einsum_path", *[(0, 1)] * len(axes)])


def audit_part(counts: np.ndarray) -> dict[str, np.ndarray]:
    """All orders and steps for one part; ``counts`` has a row per measure and a column per cell."""
    tensor = counts.reshape(len(counts), *[2] * len(FILTERS))
    steps = _steps()
    survivors = contract(tensor, _selectors(lambda order, step, axis: PASS if axis in order[:step] else ALL))
    removed = contract(
        tensor,
        _selectors(lambda order, step, axis: FAIL if axis == order[step - 1] else PASS if axis in order[:step] else ALL),
    )
    failing = contract(tensor, _selectors(lambda order, step, axis: FAIL if axis == order[step - 1] else ALL))
    alone = contract(tensor, _selectors(lambda order, step, axis: FAIL if axis == order[step - 1] else PASS))
    own = np.array([FILTERS.index(letter) for _, _, letter in steps])
    by_filter = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(by_filter, own, removed[:, 0])
    return {
        "filter_order": np.array([order for order, _, _ in steps]),
        "step": np.array([step for _, step, _ in steps], dtype=np.int32),
        "kept": survivors[:, 0],
        "removed": removed[:, 0],
        "redundant": failing[:, 0] - removed[:, 0],
        "unique_fails": alone[:, 0],
        "good_lost": removed[:, 1],
        "toxic_lost": removed[:, 2],
        "shapley": by_filter[own],
    }


def _audited(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros((len(COUNTS), CELLS), dtype=np.int64)
    counts[:, frame["cell"].to_numpy()] = frame[list(COUNTS)].to_numpy(np.int64).T
    return pd.DataFrame({"part": key[0], **audit_part(counts)})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``RESULT``."""
    return kept(cells(docs, labels), "audit-cells").groupBy("part").applyInPandas(_audited, RESULT)
