"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, so that means and deviations are exact. The leading eigenvectors of
their covariance V come from products VQ with a narrow block Q, each a pass over the centred rows
that adds up XᵀXQ. A Chebyshev polynomial of V damps the spectrum below the block's smallest Ritz
value, QR and Rayleigh-Ritz follow, and this goes on until the residuals certify the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.session import stage

# Fixed values of the contract: an entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
# Entries of this size and more have no exact whole number.
LARGEST = float(1 << 42)
GUARD, DEGREE, SEED = 24, 12, 7
# Residuals relative to the largest eigenvalue: good enough at once, or where they stop falling.
FINEST, CERTAIN = 1e-15, 1e-11
MOST_ROUNDS = 200
# Components of a smaller share of the variance are rounding errors of a vanishing one.
VANISHING = 1e-12


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector is there and has finite entries only."""
    c = F.col(vector)
    fine = c.isNotNull() & (F.size(c) > 0)
    fine &= F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("bigint") + OFFSET)
    return vectors.filter(F.coalesce(fine, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), x.alias("x")
    )


def rows_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch as a matrix of whole numbers."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums per dimension, as ``sums = n * whole + rest``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the subtraction of the whole part is exact, whatever the size of n."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)²; None where that is no 64-bit number."""
        away = x - self.whole
        bound = (self.n * (int(np.abs(away).max(initial=0)) + 1)) ** 2 * x.shape[1]
        if bound < 1 << 63:
            return np.square(self.n * away - self.rest).sum(axis=1).tolist()
        exact = np.square(self.n * away.astype(object) - self.rest.astype(object)).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact]


def centre_of(xs: DataFrame, width: int) -> Centre:
    """Counts and sums, added up exactly by Spark: a row per task and dimension is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            n += batch.num_rows
            # below 2^52 each, and fewer than 2^11 rows are added before Python's integers take over
            for first in range(0, batch.num_rows, 1024):
                total += rows_of(batch.slice(first, 1024), width).sum(axis=0)
        sums = [str(v) for v in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(sums), pa.array([n] * width, pa.int64())],
            names=["dimension", "total", "n"],
        )

    parts = xs.select("x").mapInArrow(run, "dimension int, total string, n bigint")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = parts.groupBy("dimension").agg(total, F.sum("n").alias("n")).collect()  # one row per dimension
    n = found[0].n
    sums = [int(r.total) for r in sorted(found, key=lambda r: r.dimension)]
    return Centre(n, np.array([s // n for s in sums]), np.array([s % n for s in sums]))


def summed(
    xs: DataFrame, centre: Centre, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Sum over all centred rows of the matrices of ``shape`` that ``part`` makes of some rows.

    Each task adds up its own and Spark the rest, cell by cell; the driver gets one matrix, whose
    size depends on the dimension of the vectors only.
    """
    width = len(centre.whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += part(centre.centred(rows_of(batch, width)))
        cells = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], names=["cell", "part"])

    parts = xs.select("x").mapInArrow(run, "cell int, part double")
    added = parts.groupBy("cell").agg(F.sum("part").alias("total")).toArrow()
    out = np.zeros(shape)
    out.ravel()[added.column("cell").to_numpy()] = added.column("total").to_numpy()
    return out


def damped(
    multiply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float, top: float
) -> np.ndarray:
    """A Chebyshev polynomial of V times ``q``: small on eigenvalues in 0..cut, growing above.

    Three-term recurrence, scaled to stay near one at the eigenvalue ``top``; ``vq`` is V q.
    """
    half = cut / 2
    scale = half / (top - half)
    first = scale
    before, now = q, (vq - half * q) * (scale / half)
    for _ in range(2, DEGREE + 1):
        following = 1 / (2 / first - scale)
        step = multiply(now) - half * now
        before, now = now, (2 * following / half) * step - scale * following * before
        scale = following
    return now


def leading(
    multiply: Callable[[np.ndarray], np.ndarray], width: int, count: int, guard: int = GUARD
) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their eigenvectors as columns.

    ``multiply`` gives V times a block. The result is certified twice: the residuals V q - e q have
    come down to rounding errors, and a filtered random block orthogonal to the eigenvectors has no
    larger Ritz value than the last of them.
    """
    size, count = min(width, count + guard), min(width, count)
    rng = np.random.default_rng(SEED)

    def ritz(q):
        vq = multiply(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        return values, q @ turn, vq @ turn

    def orthonormal(y):
        return np.linalg.qr(np.linalg.qr(y)[0])[0]

    values, q, vq = ritz(orthonormal(rng.standard_normal((width, size))))
    last = np.inf
    for _ in range(MOST_ROUNDS):
        top = max(values[0], 0.0)
        off = np.linalg.norm(vq - q * values, axis=0)[:count].max()
        settled = off <= FINEST * top or (off <= CERTAIN * top and off > last / 2)
        if top == 0 or size == width or settled:
            missed = _beyond(multiply, ritz, orthonormal, q[:, :count], values[:count], rng)
            if missed is None:
                return values[:count], q[:, :count]
            q[:, -1] = missed
            values, q, vq = ritz(orthonormal(q))
            last = np.inf
            continue
        last = off
        vanishing = values[-1] <= FINEST * top  # nothing to damp beyond the block
        values, q, vq = ritz(orthonormal(vq if vanishing else damped(multiply, q, vq, values[-1], top)))
    raise RuntimeError(f"no {count} certified components after {MOST_ROUNDS} rounds")


def _beyond(multiply, ritz, orthonormal, q, values, rng) -> np.ndarray | None:
    """A direction orthogonal to ``q`` with a larger eigenvalue than the last one, if there is one."""
    width, count = q.shape
    if count == width or values[0] <= 0:
        return None
    probe = rng.standard_normal((width, min(4, width - count)))
    for _ in range(3):
        probe = orthonormal(probe - q @ (q.T @ probe))
        probe = multiply(probe)
    found, vectors, _ = ritz(orthonormal(probe - q @ (q.T @ probe)))
    error = CERTAIN * values[0]
    return vectors[:, 0] if found[0] > values[-1] * (1 + 1e-9) + error else None


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per remaining row and component: ``vec_id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, empty or holds a null, non-finite or immense entry (2^42 and more)
    are dropped, and so are those of another length than most vectors have (the larger of equally
    frequent lengths). Components are numbered by falling eigenvalue; those of no variance, as in a
    table of equal vectors, are left out, as they cannot be scaled to one. Rows with the same or no
    ``vec_id`` are rows like others; an empty table gives an empty one; other columns are not read.

    The whole numbers are staged once and never shuffled; each pass reads them where they are and
    shuffles a narrow matrix per task. What the driver holds depends on the dimension only.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    xs = stage(whole_vectors(vectors, vec_id, vector), "whole-vectors")
    widths = xs.groupBy(F.size("x").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    width = most.width
    xs = xs.filter(F.size("x") == width)
    centre = centre_of(xs, width)
    n = centre.n

    def multiply(q: np.ndarray) -> np.ndarray:
        return summed(xs, centre, q.shape, lambda c: c.T @ (c @ q)) / n

    trace = summed(xs, centre, (1, 1), lambda c: np.square(c).sum(keepdims=True))[0, 0] / n
    values, q = leading(multiply, width, components)
    used = values > VANISHING * trace
    values, turn = values[used], q[:, used] / np.sqrt(values[used])
    k = len(values)
    if k == 0:
        return spark.createDataFrame([], schema)
    mean = summed(xs, centre, (1, k), lambda c: (c @ turn).sum(axis=0, keepdims=True)) / n

    def spread(c: np.ndarray) -> np.ndarray:
        w = c @ turn - mean
        return w.T @ w

    error = float(np.abs(summed(xs, centre, (k, k), spread) / n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch, width)
            whitened = centre.centred(x) @ turn
            deviation = pa.array(centre.deviations(x), pa.int64())
            where = pa.array(np.repeat(np.arange(batch.num_rows), k))
            m = len(where)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(where),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(m, n)),
                    deviation.take(where),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(values / trace, batch.num_rows)),
                    pa.array(np.full(m, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return xs.mapInArrow(run, schema)
