"""Embedding whitening: pivoted Cholesky of the scatter, one-sided Jacobi on the factor.

1.  One scan counts the fit list and adds up its dimensions, exactly.
2.  A second one centres every vector (n * x - S, exactly) and adds up its products;
    a task sends one partial sum per pair of dimensions, whatever it has read.
3.  The covariance, as large as the square of the dimensions and no larger, is
    factored in the driver: P V P' = L L' by Cholesky with the largest remaining
    diagonal entry as pivot, until what remains is rounding.  Jacobi rotations then
    make the columns of L orthogonal.  As L = U D W', the squared norms of the
    rotated columns are the eigenvalues and the normalised columns the components.
    The product L L' is never formed again, so small eigenvalues keep their digits.
4.  A third scan measures the covariance of the whitened values, a fourth returns
    them.

The entries of a vector become integers first: floor(scale * c) + offset.  Rows whose
vector is null or has null or non-finite entries are dropped.  A vector shorter than
the longest one counts as padded with entries 0; entries beyond 2**40 / scale count as
that.  Components without variance cannot be whitened and are left out: equal vectors
give no row.  A deviation beyond 64 bits is null.  Repeated rows are rows like others
and null ids are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.common import map_batches
from scholarlake.llm.vectors import finite, matrix

SCALE = 1024
OFFSET = 100_000
LIMIT = 1 << 40
COMPONENTS = 8
MOST = (1 << 63) - 1
# What remains of a dimension's variance below this share of it is rounding.
RANK_TOLERANCE = 1e-13


def integers(vectors: np.ndarray, scale: int = SCALE, offset: int = OFFSET) -> np.ndarray:
    return np.clip(np.floor(vectors * scale), -LIMIT, LIMIT).astype(np.int64) + offset


def _sums(
    rows: DataFrame, vector: str, fn: Callable[[np.ndarray], np.ndarray], wide: int
) -> np.ndarray:
    """What ``fn`` makes of the vectors of a batch, an array of fixed length, added up.

    A task adds up its own batches and sends one row per place of the array.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = fn(matrix(batch.column(0), wide))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"place": np.arange(len(total), dtype=np.int32), "part": total.astype(np.float64)}
            )

    summed = (
        rows.select(vector)
        .mapInArrow(add, "place int, part double")
        .groupBy("place")
        .agg(F.sum("part").alias("part"))
    )
    found = summed.toArrow()
    out = np.zeros(len(found))
    out[found["place"].to_numpy()] = found["part"].to_numpy()
    return out


def totals(rows: DataFrame, vector: str, scale: int, offset: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, exactly."""
    wide = rows.agg(F.max(F.size(vector))).first()[0] or 0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, np.zeros(wide, np.int64), np.zeros(wide, np.int64)
        for batch in batches:
            x = integers(matrix(batch.column(0), wide), scale, offset)
            count += len(x)
            # In two halves: neither overflows below 2**31 rows a task.
            high += (x >> 20).sum(axis=0)
            low += (x & (1 << 20) - 1).sum(axis=0)
        yield pa.RecordBatch.from_pydict(
            {
                "place": np.arange(wide + 1, dtype=np.int32),
                "high": np.append(high, 0),
                "low": np.append(low, count),
            }
        )

    halves = (
        rows.select(vector)
        .mapInArrow(add, "place int, high bigint, low bigint")
        .groupBy("place")
        .agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
        .orderBy("place")
        .collect()
    )
    sums = [(int(r.high) << 20) + int(r.low) for r in halves]
    return (sums[-1], sums[:-1]) if sums else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as exact integers: 64 bits where they fit, Python's where not."""
    largest = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, sums), default=0)
    if largest < MOST:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(z: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exactly; None beyond 64 bits."""
    largest = max(int(np.abs(z).max(initial=0)), 1)
    if largest * largest * max(z.shape[1], 1) > MOST:
        z = z.astype(object)
    squares = (z * z).sum(axis=1) if z.shape[1] else np.zeros(len(z), np.int64)
    return [None if s > MOST else s for s in map(int, squares)]


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L of as many columns as v has rank, rows in v's order, with v = L L'."""
    left = v.copy()
    wide = len(v)
    out = np.zeros((wide, wide))
    least = RANK_TOLERANCE * np.diag(v)
    done = np.zeros(wide, bool)
    for k in range(wide):
        done |= np.diag(left) <= least
        if done.all():
            return out[:, :k]
        diagonal = np.where(done, -1.0, np.diag(left))
        at = int(diagonal.argmax())
        column = np.where(done, 0.0, left[:, at]) / np.sqrt(diagonal[at])
        out[:, k] = column
        left -= np.outer(column, column)
        done[at] = True
    return out


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every two of n columns once, in rounds of pairs that share no column."""
    players = list(range(n + n % 2))
    half = len(players) // 2
    for _ in range(len(players) - 1):
        pairs = [
            (a, b)
            for a, b in zip(players[:half], reversed(players[half:]), strict=True)
            if max(a, b) < n
        ]
        if pairs:
            yield tuple(map(np.array, zip(*pairs, strict=True)))
        players = [players[0], players[-1], *players[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` rotated among each other until they are orthogonal."""
    a = factor.T.copy()  # rows here, columns of the factor
    epsilon = np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for p, q in _rounds(len(a)):
            x, y = a[p], a[q]
            xx, yy, xy = ((u * w).sum(axis=1) for u, w in ((x, x), (y, y), (x, y)))
            turn = np.abs(xy) > epsilon * np.sqrt(xx * yy)
            if not turn.any():
                continue
            rotated = True
            p, q, x, y = p[turn], q[turn], x[turn], y[turn]
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = (1 / np.hypot(1, t))[:, None]
            s = c * t[:, None]
            a[p], a[q] = c * x - s * y, s * x + c * y
        if not rotated:
            break
    return a.T


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit eigenvectors as columns."""
    rotated = one_sided_jacobi(pivoted_cholesky(v))
    values = (rotated * rotated).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:most]
    vectors = rotated[:, order] / np.sqrt(values[order])
    # Either sign is right; the largest entry positive, whoever rotates.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


def whitened(
    embeddings: DataFrame,
    most: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per vector and component: the id, component, n, deviation, whitened, explained, identity_error."""
    kind = embeddings.schema[row_id].dataType.simpleString()
    schema = (
        f"`{row_id}` {kind}, component int, n bigint, deviation bigint, whitened double,"
        " explained double, identity_error double"
    )
    rows = embeddings.select(row_id, vector).where(finite(vector))
    n, sums = totals(rows, vector, scale, offset)
    wide = len(sums)
    upper = np.triu_indices(wide)

    def units(vectors: np.ndarray) -> np.ndarray:
        """x - S / n, centred while the numbers are whole."""
        return (centred(integers(vectors, scale, offset), n, sums) / n).astype(np.float64)

    def products(vectors: np.ndarray) -> np.ndarray:
        y = units(vectors)
        return (y.T @ y)[upper]

    covariance = np.zeros((wide, wide))
    if n:
        covariance[upper] = _sums(rows, vector, products, wide) / n
        covariance += np.triu(covariance, 1).T
    if not covariance.any():
        return embeddings.sparkSession.createDataFrame([], schema)
    values, vectors = components(covariance, most)
    count = len(values)
    turned = vectors / np.sqrt(values)
    pairs = np.triu_indices(count)

    def measured(vectors: np.ndarray) -> np.ndarray:
        w = units(vectors) @ turned
        return np.concatenate([w.sum(axis=0), (w.T @ w)[pairs]])

    found = _sums(rows, vector, measured, wide) / n
    mean = found[:count]
    error = np.abs(
        found[count:] - np.outer(mean, mean)[pairs] - np.eye(count)[pairs]
    ).max()
    explained = values / np.trace(covariance)

    def project(batch: pa.RecordBatch) -> dict:
        z = centred(integers(matrix(batch.column(vector), wide), scale, offset), n, sums)
        w = (z / n).astype(np.float64) @ turned
        size = len(w)
        return {
            row_id: batch.column(row_id).take(pa.array(np.repeat(np.arange(size), count))),
            "component": np.tile(np.arange(1, count + 1, dtype=np.int32), size),
            "n": np.full(size * count, n),
            "deviation": [d for d in deviations(z) for _ in range(count)],
            "whitened": w.ravel(),
            "explained": np.tile(explained, size),
            "identity_error": np.full(size * count, error),
        }

    return map_batches(rows, project, schema)
