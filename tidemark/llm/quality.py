"""Quality by random-indexing word vectors and a small network.

Random indexing: every token has a fixed sparse random vector; the vector of a token is the sum of the
random vectors of its neighbours over the whole corpus. Tokens are runs of letters and digits and runs
of other signs, hashed to ``BUCKETS`` rows of ``DIM`` numbers, so the table has a fixed size. Each task
sums its part of the corpus, and the parts are added pairwise in a tree of bounded groups. A document is
pooled to the mean and spread of its token vectors, the likeness of neighbouring tokens and its length
on a log scale. A network with one hidden layer gives the probability; its logit is divided by a
temperature fitted on a quarter of the training rows that the weights never saw.

The network is fitted on the driver over the bounded sample of ``labelled.TRAIN_ROWS`` rows. Null and
empty texts are pooled to zeros. Without labels of both kinds every score is 0.5 exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import partsum
from tidemark.llm.labelled import fold, training_texts
from tidemark.llm.tables import documents, kept
from tidemark.llm.textops import LOWER, hashes_in_order, mix, text_chunks

BUCKETS = 1 << 13
DIM = 32
WINDOW = 2
SPREAD = 2  # entries of a random vector that are not 0
FOLDS, HELD_OUT = 3, 1
HIDDEN = 32
STEPS = 400  # at least so many updates, over however few rows

_CLASS = np.full(256, 2, dtype=np.int8)  # 0 space, 1 letters and digits, 2 other signs
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every run of one class of bytes, A-Z lower-cased."""
    data = LOWER[data]
    kind = _CLASS[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    change = np.ones(len(data) + 1, dtype=bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    first, last = edges[:-1], edges[1:]
    full = kind[first] > 0
    first, last = first[full], last[full]
    row = np.searchsorted(offsets, first, side="right") - 1
    return row, hashes_in_order(data, first, last)


def _index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the random vector's entries: two arrays of SPREAD rows."""
    bits = mix(hashes ^ np.uint64(0xA0761D6478BD642F))
    places, signs = [], []
    for k in range(SPREAD):
        part = bits >> np.uint64(16 * k)
        places.append((part & np.uint64(DIM - 1)).astype(np.int64))
        signs.append(1 - 2 * ((part >> np.uint64(8)) & np.uint64(1)).astype(np.int64))
    return np.stack(places), np.stack(signs)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BUCKETS * DIM, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column("text")):
            row, hashes = tokens_of(data, offsets)
            bucket = _bucket(hashes) * DIM
            places, signs = _index_entries(hashes)
            cells, weights = [], []
            for gap in range(1, WINDOW + 1):
                near = np.flatnonzero(row[gap:] == row[:-gap])
                for k in range(SPREAD):
                    cells += [bucket[near] + places[k][near + gap], bucket[near + gap] + places[k][near]]
                    weights += [signs[k][near + gap], signs[k][near]]
            sums = np.bincount(np.concatenate(cells), np.concatenate(weights), BUCKETS * DIM)
            table += sums.astype(np.int64)
    yield partsum.part_batch(table)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The BUCKETS x DIM table over all documents, rows scaled to length 1 (or 0)."""
    parts = kept(documents(docs).mapInArrow(_context_sums, partsum.PART_SCHEMA), "contexts")
    table = partsum.total(parts, BUCKETS * DIM).reshape(BUCKETS, DIM).astype(np.float64)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.maximum(length, 1e-9)).astype(np.float32)


FEATURES = 2 * DIM + 3


def pooled(table: np.ndarray, column: pa.Array) -> np.ndarray:
    """One row of FEATURES numbers per text."""
    out = np.zeros((len(column), FEATURES), dtype=np.float32)
    for lo, hi, data, offsets in text_chunks(column):
        row, hashes = tokens_of(data, offsets)
        if not len(row):
            continue
        vectors = table[_bucket(hashes)]
        present, begin = np.unique(row, return_index=True)
        count = np.diff(np.concatenate((begin, [len(row)])))[:, None]
        mean = np.add.reduceat(vectors, begin, axis=0) / count
        square = np.add.reduceat(vectors * vectors, begin, axis=0) / count
        alike = np.zeros(len(row), dtype=np.float32)
        same = row[1:] == row[:-1]
        alike[1:][same] = np.einsum("ij,ij->i", vectors[1:][same], vectors[:-1][same])
        repeat = np.zeros(len(row), dtype=np.float32)
        repeat[1:] = same & (hashes[1:] == hashes[:-1])
        at = lo + present
        out[at, :DIM] = mean
        out[at, DIM : 2 * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[at, 2 * DIM] = np.add.reduceat(alike, begin) / count[:, 0]
        out[at, 2 * DIM + 1] = np.add.reduceat(repeat, begin) / count[:, 0]
        out[at, 2 * DIM + 2] = np.log1p(count[:, 0])
    return out


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """Adam on three quarters of the rows; the temperature by grid on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside = order[: len(y) // 4]
    if not 0 < y[aside].sum() < len(aside):
        aside = order
    rest = order[len(y) // 4 :]
    centre, scale = x[rest].mean(axis=0), x[rest].std(axis=0) + 1e-3
    z = ((x - centre) / scale).astype(np.float64)
    share = np.clip(y[rest].mean(), 1e-3, 1 - 1e-3)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([np.log(share / (1 - share))])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(max(30, STEPS * 256 // max(len(rest), 1))):
        rng.shuffle(rest)
        for lo in range(0, len(rest), 256):
            pick = rest[lo : lo + 256]
            w1, b1, w2, b2 = params
            hidden = np.tanh(z[pick] @ w1 + b1)
            g = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -30, 30))) - y[pick]) / len(pick)
            back = np.outer(g, w2) * (1 - hidden * hidden)
            grads = [z[pick].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ g + 1e-4 * w2, np.array([g.sum()])]
            step += 1
            for p, grad, (m, s) in zip(params, grads, moments, strict=True):
                m += 0.1 * (grad - m)
                s += 0.001 * (grad * grad - s)
                p -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    w1, b1, w2, b2 = params
    logit = np.tanh(z[aside] @ w1 + b1) @ w2 + b2[0]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    temperature = min(grid, key=lambda t: _loss(logit / t, y[aside]))
    return Network(centre, scale, w1, b1, w2, float(b2[0]), float(temperature))


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT) -> Network | None:
    """None where the training rows do not hold both labels."""

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(pooled(table, batch.column("text"))), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), x], ["doc_id", "label", "x"])

    sample = training_texts(docs, labels, label, folds, held_out)
    # At most labelled.TRAIN_ROWS rows of FEATURES numbers.
    data = sample.mapInArrow(pool, "doc_id long, label double, x array<float>").toArrow()
    order = np.lexsort((data.column("label").to_numpy(), data.column("doc_id").to_numpy()))
    y = data.column("label").to_numpy()[order]
    if len(y) == 0 or y.min() == y.max():
        return None
    x = data.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)[order]
    return fit(x, y)


def score(docs: DataFrame, table: np.ndarray, model: Network | None, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                out = np.full(batch.num_rows, 0.5)
            else:
                out = model.scores(pooled(table, batch.column("text")).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    scored = documents(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    table = word_vectors(docs)
    return score(docs, table, train(docs, labels, table))
