"""Whitening of vectors by their leading principal components, with Jacobi-Davidson.

The covariance is never formed.  The vectors lie in a stored table of packed blocks, and
one Spark job multiplies the centred vectors with a thin block of directions: every task
returns the sums for its blocks, which Spark adds up.  The driver holds a few hundred
vectors of the vectors' own dimension, whatever their number.

Jacobi-Davidson for the largest eigenvalues (:func:`leading_eigenpairs`): Rayleigh-Ritz
over a growing subspace gives approximate pairs; leading pairs whose residuals have reached
double precision are locked.  For the others one correction equation each, projected off
the locked and current directions, is solved by a few steps of MINRES; all equations take
their steps together, so that a step is one job.  The corrections enlarge the subspace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sheetloom.session import durable

COMPONENTS = 32
GUARD = 8               # directions beyond those wanted
INNER = 6               # MINRES steps for a correction
SUBSPACE = 4            # the subspace restarts at so many times the first block
ROUNDS = 200
SEED = 11
SCALE, SHIFT = 64, 1_000_000
REACH = 1 << 40         # scaled entries beyond are set to this bound
BLOCK_BYTES = 1 << 20
NULL = 1e-11            # an eigenvalue below this share of the largest is taken as zero


def _norms(block: np.ndarray) -> np.ndarray:
    return np.sqrt((block * block).sum(axis=0))


def _off(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """A block without its parts in some orthonormal bases, twice for rounding."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
    return block


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what a block adds to some bases; what adds nothing goes."""
    size = _norms(block)
    block = block[:, size > 0] / size[size > 0]
    block = _off(block, *bases)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10]
    return np.linalg.qr(_off(u, *bases))[0] if u.shape[1] else u


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Solve ``A_i x_i = b_i`` for the columns of ``rhs``, all in step; ``apply`` maps a
    block of directions by their own symmetric matrices.  A column that is done stands still."""
    x = np.zeros_like(rhs)
    before, last = rhs, rhs
    beta = first = _norms(rhs)
    old = np.ones_like(beta)
    dbar, epsilon, sine = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    cosine, phibar = -np.ones_like(beta), beta.copy()
    w, w2 = np.zeros_like(rhs), np.zeros_like(rhs)
    y = rhs
    for step in range(steps):
        live = (beta > 1e-14 * first) & (phibar > 1e-3 * first)
        if not live.any():
            break
        v = y / np.where(beta > 0, beta, 1)
        y = apply(v)
        if step:
            y = y - (beta / old) * before
        alpha = (v * y).sum(axis=0)
        y = y - (alpha / np.where(beta > 0, beta, 1)) * last
        before, last = last, y
        old, beta = np.where(beta > 0, beta, 1), _norms(y)
        previous = epsilon
        delta, gbar = cosine * dbar + sine * alpha, sine * dbar - cosine * alpha
        epsilon, dbar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(gbar, beta), 1e-300)
        cosine, sine = gbar / gamma, beta / gamma
        phi, phibar = cosine * phibar, sine * phibar
        w, w2 = (v - previous * w2 - delta * w) / gamma, w
        x = x + np.where(live, phi, 0) * w
    return x


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int
                       ) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors (columns) of a
    symmetric positive semi-definite matrix that is given by its product with a block.

    Residuals are at most ``16 * sqrt(dim)`` units of rounding of the largest eigenvalue,
    or what a subspace of the whole dimension gives.  Raises if ``ROUNDS`` do not suffice.
    """
    wanted = min(wanted, dim)
    width = min(dim, wanted + GUARD)
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, width)))[0]
    image = product(basis)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        vectors, images = basis @ turn, image @ turn
        residual = _off(images - vectors * theta, locked) if locked.shape[1] else images - vectors * theta
        largest = max(np.abs(theta).max(initial=0), values.max(initial=0))
        done = _norms(residual) <= 16 * np.sqrt(dim) * np.finfo(float).eps * max(largest, 1e-300)
        if locked.shape[1] + basis.shape[1] == dim:
            done[:] = True          # the whole space: nothing is left to add
        more = wanted - locked.shape[1]
        ready = int(np.argmin(np.append(done[:more], False)))     # leading pairs only: no gap in the order
        if ready:
            locked = np.hstack([locked, vectors[:, :ready]])
            values = np.append(values, theta[:ready])
            theta, vectors, images, residual = theta[ready:], vectors[:, ready:], images[:, ready:], residual[:, ready:]
        if locked.shape[1] == wanted:
            return _settled(product, locked)
        width = min(wanted + GUARD - locked.shape[1], dim - locked.shape[1], vectors.shape[1])
        if vectors.shape[1] > SUBSPACE * (wanted + GUARD):
            vectors, images = vectors[:, :2 * width], images[:, :2 * width]
        near, shift = vectors[:, :width], theta[:width]

        def apply(block):
            block = _off(block, locked, near)
            return _off(product(block) - block * shift, locked, near)

        corrections = minres(apply, _off(-residual[:, :width], locked, near), INNER)
        added = _orthonormal(corrections, locked, vectors)
        if not added.shape[1]:      # nothing new: go on in a random direction
            fresh = np.random.default_rng(SEED + locked.shape[1]).standard_normal((dim, 1))
            added = _orthonormal(fresh, locked, vectors)
        room = dim - locked.shape[1] - vectors.shape[1]
        added = added[:, :room]
        basis, image = np.hstack([vectors, added]), np.hstack([images, product(added)])
    raise RuntimeError(f"eigenvectors did not settle in {ROUNDS} rounds")


def _settled(product, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A last Rayleigh-Ritz over all locked vectors."""
    vectors = np.linalg.qr(vectors)[0]
    small = vectors.T @ product(vectors)
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return theta[::-1].copy(), vectors @ turn[:, ::-1]


class Centre:
    """Sums of the integer vectors, and vectors centred without loss."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.floor = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double precision, rounded once."""
        return (x - self.floor).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Per row the sum of ``(n * x - S) ** 2``, exact."""
        low = x - self.floor
        bound = self.n * (int(np.abs(low).max(initial=0)) + 1)
        if bound * bound * x.shape[1] < 1 << 63:
            y = self.n * low - self.rest
            return (y * y).sum(axis=1).tolist()
        y = low.astype(object) * self.n - self.rest.astype(object)
        return (y * y).sum(axis=1).tolist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        entries = pc.list_flatten(batch.column("embedding")).to_numpy(zero_copy_only=False).astype(np.float64)
        entries = entries.reshape(batch.num_rows, -1)
        x = np.clip(np.floor(SCALE * np.clip(entries, -REACH, REACH)), -REACH, REACH).astype(np.int64) + SHIFT
        ids = batch.column("vec_id").to_pylist()
        rows = max(1, BLOCK_BYTES // (8 * x.shape[1]))
        starts = range(0, len(x), rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[s:s + rows] for s in starts], pa.list_(pa.int64())),
             pa.array([x[s:s + rows].tobytes() for s in starts], pa.binary())], names=["ids", "data"])


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for data in batch.column("data"):
            yield np.frombuffer(data.as_py(), dtype=np.int64).reshape(-1, dim)


class FitList:
    """All vectors as a stored table of packed integer blocks."""

    def __init__(self, vectors: DataFrame):
        usable = vectors.where(
            F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
        usable = usable.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
        dims = usable.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1)
        self.dim, self.n = next(iter(dims.collect()), (0, 0))
        self.blocks = None
        if not self.n:
            return
        self.blocks = durable(usable.where(F.size("embedding") == self.dim)
                              .mapInArrow(_packed, "ids array<long>, data binary"))
        dim = self.dim

        def sums(batches):
            for x in _matrices(batches, dim):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(dim, dtype=np.int32)), pa.array(x.sum(axis=0))], names=["cell", "value"])

        total = (self.blocks.mapInArrow(sums, "cell int, value long").groupBy("cell")
                 .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
        found = {r["cell"]: int(r["value"]) for r in total}
        self.centre = Centre(self.n, [found[i] for i in range(dim)])

    def summed(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all blocks of a function of the centred vectors, added up by Spark."""
        dim, centre = self.dim, self.centre

        def run(batches):
            total = np.zeros(shape)
            for x in _matrices(batches, dim):
                total += part(centre.centred(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "value"])

        rows = (self.blocks.mapInArrow(run, "cell int, value double")
                .groupBy("cell").agg(F.sum("value").alias("value")).collect())
        out = np.zeros(int(np.prod(shape)))
        for cell, value in rows:
            out[cell] = value
        return out.reshape(shape)

    def product(self, directions: np.ndarray) -> np.ndarray:
        """Covariance times a block of directions, without the covariance."""
        return self.summed(lambda c: c.T @ (c @ directions), directions.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([(c * c).sum()]), (1,))[0]) / self.n


RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
          "explained double, identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and
    component of the entries ``x = floor(64 * entry) + 1000000``.

    Rows whose vector is null or empty, or holds null or non-finite entries, are left out,
    and so are vectors of another length than the most frequent one (of equally frequent
    lengths the longest).  There are as many components as asked, but not more than the
    dimension, and none with a variance below ``NULL`` of the largest: in such directions
    nothing can be whitened.  Scaled entries beyond ``REACH`` are set to it.  ``deviation``
    is exact.  Repeated rows each count and give rows; a null vec_id stays null; tables
    without usable vectors, or where all are equal, give no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    fit = FitList(vectors)
    if not fit.n:
        return spark.createDataFrame([], RESULT)
    trace = fit.trace()
    if trace <= 0:
        return spark.createDataFrame([], RESULT)
    values, axes = leading_eigenpairs(fit.product, fit.dim, components)
    kept = values > NULL * values[0]
    values, axes = values[kept], axes[:, kept]
    turn = axes / np.sqrt(values)
    k = len(values)
    mean = fit.summed(lambda c: (c @ turn).sum(axis=0), (k,)) / fit.n
    spread = fit.summed(lambda c: (c @ turn - mean).T @ (c @ turn - mean), (k, k)) / fit.n
    error = float(np.abs(spread - np.eye(k)).max())
    n, dim, centre, explained = fit.n, fit.dim, fit.centre, values / trace

    def run(batches):
        for batch in batches:
            for ids, data in zip(batch.column("ids").to_pylist(), batch.column("data")):
                x = np.frombuffer(data.as_py(), dtype=np.int64).reshape(-1, dim)
                rows = len(x)
                each = np.repeat(np.arange(rows), k)
                deviation = pa.array(centre.deviation(x), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array((centre.centred(x) @ turn).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error))],
                    names=[f.split()[0] for f in RESULT.replace("(38,0)", "").split(", ")])

    return fit.blocks.mapInArrow(run, RESULT)
