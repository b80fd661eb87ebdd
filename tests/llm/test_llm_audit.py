"""Filter interaction audit against applying the filters one by one, in every order."""

import re
from collections import Counter
from itertools import permutations

import numpy as np

from llm_fixtures import as_rows, empty, messy, messy_rows
from tidemark.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = [(k, k % 2, k % 3 == 0) for k in range(1, 21)] + [(3, 0, True), (None, 1, True), (4, None, None), (999, 1, True)]


def failing(text: str, doc_id, first: dict) -> set:
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
        out.add("C")
    if any(c in "#$%&*|" for c in text):
        out.add("D")
    if doc_id is not None and doc_id > first[text]:
        out.add("E")
    return out


def one_by_one(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text, lang) rows with the labels above."""
    quality, toxic, first = {}, {}, {}
    for k, q, t in LABELS:
        if k is not None:
            quality[k], toxic[k] = max(quality.get(k, 0), q or 0), max(toxic.get(k, 0), int(t or 0))
    for k, text, _ in rows:
        if k is not None:
            first[text] = min(first.get(text, k), k)
    fails = [failing(text, k, first) for k, text, _ in rows]
    out = []
    for part in sorted({lang for *_, lang in rows}):
        own = [at for at, r in enumerate(rows) if r[2] == part]
        removed_by, found = Counter(), []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                gone = [at for at in left if letter in fails[at]]
                earlier = set(own) - set(left)
                left = [at for at in left if letter not in fails[at]]
                removed_by[letter] += len(gone)
                found.append((
                    part, "".join(order), step, len(left), len(gone), sum(letter in fails[at] for at in earlier),
                    sum(fails[at] == {letter} for at in own), sum(quality.get(rows[at][0], 0) == 1 for at in gone),
                    sum(toxic.get(rows[at][0], 0) == 1 for at in gone), letter,
                ))
        out += [(*f[:-1], removed_by[f[-1]]) for f in found]
    return sorted(out, key=repr)


def labels(spark):
    return spark.createDataFrame([(k, q, None if t is None else int(t), "x") for k, q, t in LABELS], "doc_id BIGINT, quality INT, toxic INT, text STRING")


def test_every_order_and_step(spark):
    langs = [None, "", "de", "fr"]
    rows = [(r[0], r[1], langs[k % 4], *r[3:]) for k, r in enumerate(messy_rows())]
    rows += [(100 + k, "100% of it is #1", "de", *rows[0][3:]) for k in range(30)]  # one text of many ids
    rows += [(100, "100% of it is #1", "fr", *rows[0][3:])] * 3  # its first id again, in another part
    docs = spark.createDataFrame(rows, messy(spark).schema).repartition(4)
    wanted = one_by_one([(r[0], r[1] or "", r[2] or "") for r in rows])
    got = as_rows(filter_audit.audit(docs, labels(spark)), *COLUMNS)
    assert got == wanted


def test_empty_tables(spark):
    assert filter_audit.audit(empty(spark), labels(spark)).collect() == []
    got = filter_audit.audit(messy(spark), labels(spark).limit(0)).collect()
    assert len(got) == 600 and {r["good_lost"] + r["toxic_lost"] for r in got} == {0}


def test_contractions_add_up():
    counts = np.random.default_rng(1).integers(0, 50, (3, 32))
    rows = filter_audit.audit_part(counts)
    total = counts[0].sum()
    for order in set(rows["filter_order"]):
        own = rows["filter_order"] == order
        assert rows["removed"][own].sum() + rows["kept"][own][-1] == total
        assert rows["kept"][own][-1] == counts[0][0]
    steps = rows["step"] == 1
    assert (rows["redundant"][steps] == 0).all()
