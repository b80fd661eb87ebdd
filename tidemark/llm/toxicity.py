"""Toxicity by a factorization machine over hashed terms.

A document is the set of its hashed terms: runs of letters and digits (A-Z lower-cased), pairs of
neighbours, and the first four and five bytes of longer runs. The model is w0 + sum of weights + sum over pairs of <v_i, v_j>, so that two harmless terms
can be harmful together. Which hashed terms the model knows is decided by their association with the
label over the training rows; at most ``TERMS`` of 2^20. Training runs on the driver over the bounded
sample of ``labelled.TRAIN_ROWS`` rows, each reduced to the known terms.

Null and empty texts get the score of a text without terms. Without labels of both kinds every score
is 0. Rows without doc_id are scored like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import fold, training_texts
from tidemark.llm.tables import documents, kept
from tidemark.llm.textops import LOWER, RangeHashes, mix, text_chunks, words_of

HASH_BITS = 20
STARTS = (4, 5)  # bytes of a word's start that are terms of their own: stems under many endings
TERMS = 2048
RANK = 8
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
STEPS = 1200  # at least so many updates, over however few rows
MIN_DOCUMENTS = 5
MIN_CHI_SQUARE = 25.0  # weaker associations are chance among so many terms

_GAPS = np.ones(256, dtype=bool)
_GAPS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
_MASK = np.uint64((1 << HASH_BITS) - 1)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed term), with repeats: words, pairs of neighbours, and the starts of longer words."""
    data = LOWER[data]
    first, last, row = words_of(data, offsets, _GAPS)
    if not len(first):
        return row, np.zeros(0, np.int64)
    ranges = RangeHashes(data)
    one = ranges.of(first, last)
    with np.errstate(over="ignore"):
        two = mix(one[:-1] * np.uint64(0x9DDFEA08EB382D69) + one[1:])
    together = row[:-1] == row[1:]
    terms, rows = [one, two[together]], [row, row[:-1][together]]
    for size in STARTS:
        longer = np.flatnonzero(last - first > size)
        # Apart from the word of the same bytes.
        terms.append(mix(ranges.of(first[longer], first[longer] + size) ^ np.uint64(size)))
        rows.append(row[longer])
    return np.concatenate(rows).astype(np.int64), (np.concatenate(terms) & _MASK).astype(np.int64)


def term_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without repeats, sorted by row."""
    rows, terms = terms_of(data, offsets)
    packed = np.unique(rows << HASH_BITS | terms)
    return packed >> HASH_BITS, packed & int(_MASK)


@dataclass(frozen=True)
class Machine:
    terms: np.ndarray  # known hashed terms, ascending
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # terms x rank

    def scores(self, rows: np.ndarray, known: np.ndarray, n: int) -> np.ndarray:
        """Probability for rows 0..n-1 given (row, place in ``terms``)."""
        total = np.full(n, self.bias)
        total += np.bincount(rows, self.linear[known], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[known, f]
            total += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _lookup(terms: np.ndarray) -> np.ndarray:
    place = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    place[terms] = np.arange(len(terms))
    return place


def _training_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column("label")
        for lo, hi, data, offsets in text_chunks(batch.column("text")):
            rows, terms = term_sets(data, offsets)
            cut = np.searchsorted(rows, np.arange(hi - lo + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(terms, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), label.slice(lo, hi - lo), lists], ["doc_id", "label", "terms"]
            )


def _fit(x_rows: np.ndarray, x_terms: np.ndarray, y: np.ndarray, width: int, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam over shuffled batches made dense one at a time."""
    rng = np.random.default_rng(seed)
    n = len(y)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    params = [np.array([np.log(prior / (1 - prior))]), np.zeros(width), rng.normal(0, 0.01, (width, RANK))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    cut = np.searchsorted(x_rows, np.arange(n + 1))
    step = 0
    for _ in range(max(12, STEPS * 512 // max(n, 1))):
        order = rng.permutation(n)
        for lo in range(0, n, 512):
            pick = order[lo : lo + 512]
            x = np.zeros((len(pick), width))
            for k, r in enumerate(pick):
                x[k, x_terms[cut[r] : cut[r + 1]]] = 1
            b, w, v = params
            inner = x @ v
            z = b[0] + x @ w + 0.5 * (inner**2 - x @ (v * v)).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
            xg = x.T @ g
            grads = [np.array([g.sum()]), xg + 1e-5 * w, x.T @ (g[:, None] * inner) - v * xg[:, None] + 1e-5 * v]
            step += 1
            for p, grad, (m, s) in zip(params, grads, moments, strict=True):
                m += 0.1 * (grad - m)
                s += 0.001 * (grad * grad - s)
                p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return float(params[0][0]), params[1], params[2]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT) -> Machine | None:
    """None where the training rows do not hold both labels."""
    sample = training_texts(docs, labels, label, folds, held_out)
    rows = kept(sample.mapInArrow(_training_terms, "doc_id long, label double, terms array<int>"), "terms")
    n1, n0 = (rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first() or (None, None))
    if not n1 or not n0:
        return None
    # Chi-square of each hashed term with the label, over all training rows.
    share1, share0 = F.col("d1") / n1, F.col("d0") / n0
    pooled = (F.col("d1") + F.col("d0")) / (n1 + n0)
    strength = (share1 - share0) ** 2 / (pooled * (1 - pooled) * (1 / n1 + 1 / n0) + 1e-12)
    best = (
        rows.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("label").alias("d1"), F.sum(1 - F.col("label")).alias("d0"))
        .where((F.col("d1") + F.col("d0") >= MIN_DOCUMENTS) & (strength >= MIN_CHI_SQUARE))
        .orderBy(strength.desc(), "term")
        .limit(TERMS)
        .select("term")
    )
    terms = np.array(sorted(r[0] for r in best.collect()), dtype=np.int64)
    known = F.array_intersect("terms", F.lit(terms.astype(int).tolist()).cast("array<int>"))
    # At most labelled.TRAIN_ROWS rows of at most TERMS numbers.
    data = rows.select("doc_id", "label", known.alias("terms")).orderBy("doc_id", "label").toArrow()
    lists = data.column("terms").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    place = _lookup(terms)
    x_terms = place[lists.flatten().to_numpy()]
    x_rows = np.repeat(np.arange(len(lengths)), lengths)
    bias, linear, factors = _fit(x_rows, x_terms, data.column("label").to_numpy(), len(terms))
    return Machine(terms, bias, linear, factors)


def _batch_scores(model: Machine | None, place: np.ndarray | None, column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column))
    if model is not None:
        for lo, hi, data, offsets in text_chunks(column):
            rows, terms = terms_of(data, offsets)
            at = place[terms].astype(np.int64)
            have = at >= 0
            known = np.unique(rows[have] << HASH_BITS | at[have])
            out[lo:hi] = model.scores(known >> HASH_BITS, known & int(_MASK), hi - lo)
    return out


def score(docs: DataFrame, model: Machine | None, threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _lookup(model.terms) if model else None
        for batch in batches:
            out = _batch_scores(model, place, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    scored = documents(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is toxic; decided row by row, so repeated ids may differ."""
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _lookup(model.terms) if model else None
        for batch in batches:
            out = _batch_scores(model, place, batch.column("text"))
            yield batch.filter(pa.array(out < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
