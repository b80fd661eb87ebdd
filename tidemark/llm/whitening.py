"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Every entry c of a vector becomes the whole number x = floor(64 c) + 1000000. Counts, sums and deviations
are whole numbers and exact. Covariances are over all vectors, centred before multiplying: with
S = n m + r, an entry less its mean is (x - m) - r / n, where x - m is a small whole number.

The scatter A of the centred vectors is summed over tasks in a tree; what reaches the driver is one square
of numbers per sum, of the vectors' length whatever their count. There A is factored with pivoting,
A = L L', stopping where nothing is left. One-sided Jacobi turns pairs of columns of L until all are
orthogonal, W = L Q; as A = W W', the squared norms of W's columns are the eigenvalues of A and the
normalised columns its eigenvectors. Squared norms over n are those of the covariance.

Vectors that are null or hold null or non-finite entries are dropped, as are entries beyond 2^52 in x. Of
vectors of different lengths those of the most frequent one stay (of equally frequent ones the longest).
A missing vec_id stays null; repeated rows count and come out each. Components without variance (an
eigenvalue of at most length * 2^-52 of the largest) do not exist, so fewer vectors than entries give fewer
components, and none are left of one vector, of equal ones and of an empty table, which give no rows.
Of each component the entry of largest size is positive. A deviation above 2^63 fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.partsum import FAN_IN, part_number
from tidemark.llm.tables import kept

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 52)
_EPS = float(np.finfo(np.float64).eps)
_PART = "part long, sums binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    # NaN is above every number in a comparison, and so are infinities above the limit.
    fine = lambda c: c.isNotNull() & (F.abs(c) * SCALE < LARGEST - 2 * SHIFT)
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", lambda c: F.coalesce(fine(c), F.lit(False))))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size("vector") == (top["length"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Scaled whole numbers, a row per vector."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(len(column), -1) + SHIFT


def _part(sums: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([part_number()], pa.int64()), pa.array([sums.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["part", "sums"])


def _summed(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], kind: type) -> np.ndarray | None:
    """The sum of ``of_batch`` over all batches: per task, then up a tree in the order of the tasks."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            if batch.num_rows:
                more = of_batch(batch)
                sums = more if sums is None else sums + more
        if sums is not None:
            yield _part(sums)

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(frame["part"].min()) // FAN_IN], "sums": [add_up(frame)]})

    def add_up(frame: pd.DataFrame) -> bytes:
        sums = None
        for raw in frame.sort_values("part", kind="stable")["sums"]:
            more = np.frombuffer(raw, dtype=kind)
            sums = more if sums is None else sums + more
        return sums.tobytes()

    parts = kept(rows.mapInArrow(of_task, _PART), "sums")
    widest = parts.agg(F.max("part")).first()[0] or 0
    while widest >= FAN_IN:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group"))
        parts = kept(grouped.applyInPandas(added, _PART), "sums")
        widest //= FAN_IN
    last = parts.toPandas()
    return np.frombuffer(add_up(last), dtype=kind) if len(last) else None


def _centred(x: np.ndarray, mean: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    return (x - mean).astype(np.float64) - rest / n


def _deviations(x: np.ndarray, mean: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2 per row, exact."""
    apart = x - mean
    if len(apart) and x.shape[1] * (n * (int(np.abs(apart).max()) + 1)) ** 2 >= 1 << 63:
        apart = apart.astype(object)
    return ((apart * n - rest) ** 2).sum(axis=1)


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L with scatter = L L': triangular up to the order of its rows, a column per pivot."""
    d = len(scatter)
    factor, left = np.zeros((d, d)), scatter.diagonal().copy()
    order, floor = np.arange(d), d * _EPS * max(scatter.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        at = k + int(np.argmax(left[order[k:]]))
        if left[order[at]] <= floor:
            return factor[:, :k]
        order[[k, at]] = order[[at, k]]
        top, below = order[k], order[k + 1 :]
        factor[top, k] = np.sqrt(left[top])
        factor[below, k] = (scatter[below, top] - factor[below, :k] @ factor[top, :k]) / factor[top, k]
        left[below] -= factor[below, k] ** 2
    return factor


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs without a common column."""
    seats = list(range(n)) + [-1] * (n % 2)
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(a, b) for a, b in zip(seats[:half], seats[: half - 1 : -1], strict=True) if min(a, b) >= 0]
        yield np.array([min(p) for p in pairs], dtype=int), np.array([max(p) for p in pairs], dtype=int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def orthogonal_columns(factor: np.ndarray, most_sweeps: int = 60) -> np.ndarray:
    """One-sided Jacobi: the factor times rotations, with columns orthogonal to double precision."""
    turned = factor.copy()
    limit = _EPS * max(len(factor), 1)
    for _ in range(most_sweeps):
        worst = 0.0
        for p, q in _rounds(turned.shape[1]):
            x, y = turned[:, p], turned[:, q]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            angle = np.abs(c) / np.sqrt(a * b)
            worst = max(worst, float(angle.max(initial=0.0)))
            turn = angle > _EPS
            safe = np.where(turn, c, 1.0)
            zeta = (b - a) / (2 * safe)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, t)
            turned[:, p], turned[:, q] = cos * x - cos * t * y, cos * t * x + cos * y
        if worst <= limit:
            return turned
    raise ArithmeticError("rotations did not settle")


def principal_axes(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a scatter matrix, largest first."""
    turned = orthogonal_columns(pivoted_cholesky(scatter))
    values = (turned * turned).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(scatter) * _EPS * values.max(initial=0.0)]
    values, axes = values[order], turned[:, order] / np.sqrt(values[order])
    if axes.size:
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return values, axes


def _numbers(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    rows = usable(embeddings)
    first = _summed(rows, lambda b: np.append(_matrix(b.column("vector")).sum(axis=0), b.num_rows), np.int64)
    n, total = (int(first[-1]), first[:-1]) if first is not None else (1, np.zeros(0, np.int64))
    mean, rest = total // n, total % n

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _centred(_matrix(batch.column("vector")), mean, rest, n)

    def scattered(batch: pa.RecordBatch) -> np.ndarray:
        away = centred(batch)
        return (away.T @ away).ravel()

    squares = _summed(rows, scattered, np.float64)
    scatter = (squares if squares is not None else np.zeros(0)).reshape(len(total), -1) if len(total) else np.zeros((0, 0))
    values, axes = principal_axes(scatter)
    explained = values / np.trace(scatter) if len(values) else values
    values, axes = values[:components], axes[:, :components]
    scaled = axes / np.sqrt(values / n)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"))
            white = _centred(x, mean, rest, n) @ scaled
            offsets = pa.array(np.arange(len(white) + 1) * scaled.shape[1], pa.int32())
            arrays = [
                batch.column("vec_id"),
                pa.array([int(v) for v in _deviations(x, mean, rest, n)], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(white.ravel(), pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "deviation", "white"])

    white = kept(rows.where(F.lit(bool(len(values)))).mapInArrow(projected, "vec_id long, deviation long, white array<double>"), "white")

    def of_white(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("white").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)

    centre = _summed(white, lambda b: of_white(b).sum(axis=0), np.float64)
    middle = centre / n if centre is not None else 0.0

    def spread(batch: pa.RecordBatch) -> np.ndarray:
        away = of_white(batch) - middle
        return (away.T @ away).ravel()

    squares = _summed(white, spread, np.float64)
    error = 0.0
    if squares is not None:
        error = float(np.abs(squares.reshape(len(values), -1) / n - np.eye(len(values))).max())
    shares = _numbers(explained[:components])
    return white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
