"""Embedding whitening by a block Jacobi-Davidson method.

The covariance matrix is never formed: it is met only through products with blocks of a few vectors, each of which is one
distributed pass over the centred vectors. All that the driver holds is bases of some dozens of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import stored

SCALE, SHIFT, COMPONENTS, SEED = 64, 1_000_000, 16, 20240611
#: Bytes of coordinates in one block of the fit list, about.
BLOCK_BYTES = 1 << 20
EPS = np.finfo(np.float64).eps


def minres(operator: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Columns t with ``operator(t)`` near the columns of ``b``, by MINRES on all columns in lockstep.

    ``operator`` is symmetric for each column. It stops when every residual has fallen by ``reduction``.
    """
    beta = np.linalg.norm(b, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_old = b / start, np.zeros_like(b)
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    eta, beta_now = beta.copy(), np.zeros_like(beta)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = operator(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta_now
        rho1 = np.hypot(delta, beta_next)
        rho2 = s * alpha + c_old * c * beta_now
        rho3 = s_old * beta_now
        safe = np.where(rho1 > 0, rho1, 1.0)
        c_old, c, s_old, s = c, delta / safe, s, beta_next / safe
        w, w_old = (v - rho3 * w_old - rho2 * w) / safe, w
        x = x + np.where(rho1 > 0, c * eta, 0.0) * w
        eta = -s * eta
        v, v_old, beta_now = p / np.where(beta_next > 0, beta_next, 1.0), v, beta_next
        if (np.abs(eta) <= reduction * beta).all():
            break
    return x


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``t`` without what lies in ``against``, which are orthonormal."""
    q = np.hstack(against)
    for _ in range(3):
        t = t - q @ (q.T @ t)
        norms = np.linalg.norm(t, axis=0)
        t = t[:, norms > 0] / norms[norms > 0]
        u, size, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, size > 1e-8]
    return t


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dimensions: int, count: int, steps: int = 6, most: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, of the symmetric positive semidefinite operator ``product``, and unit
    eigenvectors as columns.

    Each round projects the operator on the subspace (Rayleigh-Ritz), locks leading pairs whose residual has come down to
    double precision, and extends the subspace by the solutions of the correction equations of all others, projected
    against locked and current vectors. A subspace that has grown large is cut to its best Ritz vectors.
    """
    count = min(count, dimensions)
    width = min(dimensions, count + 8)
    basis = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dimensions, width)))[0]
    image = product(basis)
    locked, values = np.zeros((dimensions, 0)), []
    for turn in range(most):
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, ritz_image = basis @ y, image @ y
        residual = ritz_image - ritz * theta
        residual -= locked @ (locked.T @ residual)
        scale = max([*values, *theta[:1], 0.0])
        good = np.linalg.norm(residual, axis=0) <= 16 * EPS * np.sqrt(dimensions) * scale
        done = 0
        while len(values) < count and done < ritz.shape[1] and good[done]:
            values.append(theta[done])
            done += 1
        locked, basis, image = np.hstack([locked, ritz[:, :done]]), ritz[:, done:], ritz_image[:, done:]
        if len(values) == count:
            return np.array(values), locked
        theta, residual = theta[done:], residual[:, done:]
        left = min(count - len(values), basis.shape[1])
        if basis.shape[1] > min(dimensions, 4 * width) - left:
            basis, image, theta, residual = (z[..., : left + 8] for z in (basis, image, theta, residual))
        current = np.hstack([locked, basis[:, :left]])
        away = lambda z, q=current: z - q @ (q.T @ z)
        correct = lambda z, shift=theta[:left], away=away: away(product(away(z)) - shift * away(z))
        more = minres(correct, -away(residual[:, :left]), steps, 0.5 ** (turn + 1))
        more = _orthonormal(more, locked, basis)
        if not more.shape[1]:  # the basis spans all that is left: only rounding can be wrong
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    raise ArithmeticError(f"{len(values)} of {count} eigenpairs after {most} rounds")


def whole_coordinates(vector: Column) -> tuple[Column, Column]:
    """Whether a vector counts (not null, no null or non-finite entries), and its entries c as floor(64 c) + 1000000.

    Entries of 2^56 or more, whose coordinates no long can hold, count as not finite.
    """
    doubles = vector.cast("array<double>")
    good = F.coalesce(F.forall(doubles, lambda c: F.coalesce(F.abs(c) < float(1 << 56), F.lit(False))), F.lit(False))
    return good, F.transform(doubles, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))


def _blocks(distinct: DataFrame, dimensions: int) -> DataFrame:
    """Vectors ``x`` side by side in binary blocks of little-endian longs."""
    rows = max(1, BLOCK_BYTES // (8 * dimensions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                flat = batch.column(0).slice(at, rows).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([flat.astype("<i8").tobytes()])], ["block"])

    return distinct.select("x").mapInArrow(run, "block binary")


class FitList:
    """Distinct vectors in blocks; sums over them run as Spark jobs."""

    def __init__(self, blocks: DataFrame, dimensions: int):
        self.blocks, self.dimensions = blocks, dimensions
        sums = self._sum(lambda x: np.append(x.sum(0), len(x)), dimensions + 1, "bigint")
        self.sums, self.n = sums[:-1].astype(np.int64), int(sums[-1])

    def _sum(self, f: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
        """Sum of the flat arrays ``f(x)`` over all blocks x; each task sends one array of ``size`` entries."""
        dimensions, exact = self.dimensions, kind == "bigint"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64 if exact else np.float64)
            for batch in batches:
                for block in batch.column(0):
                    total += f(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dimensions))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "value"])

        out = np.zeros(size, np.int64 if exact else np.float64)
        for at, value in self.blocks.mapInArrow(run, f"at bigint, value {kind}").groupBy("at").agg(F.sum("value")).collect():
            out[at] = value
        return out

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        """x - S/n of rows of longs: the numerator is exact."""
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n

    def product(self, w: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``w``."""
        centred = self.centred()

        def f(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return (c.T @ (c @ w)).ravel()

        return self._sum(f, w.size).reshape(w.shape) / self.n

    def trace(self) -> float:
        centred = self.centred()
        return float(self._sum(lambda x: np.square(centred(x)).sum(0), self.dimensions).sum()) / self.n

    def covariance_of(self, project: np.ndarray) -> np.ndarray:
        """Covariance of the centred vectors times ``project``."""
        centred, k = self.centred(), project.shape[1]

        def f(x: np.ndarray) -> np.ndarray:
            z = centred(x) @ project
            return (z.T @ z).ravel()

        return self._sum(f, k * k).reshape(k, k) / self.n


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of ``embeddings`` (vec_id, embedding), a row for each vector and component.

    Entries c become longs floor(64 c) + 1000000; each distinct vector counts once in sums S, n and covariance. Returns
    vec_id, component (from 1, by falling eigenvalue), n, deviation (squared entries of n x - S, summed; null where no
    long holds it), whitened, explained (eigenvalue over trace) and identity_error (the largest deviation of the whitened
    covariance from the identity). Rows whose vector is null or holds null, non-finite or huge entries (2^56 and more)
    are left out, and so are vectors that haven't the number of entries that most have (the larger at a tie). Components
    without variance are left out: equal vectors alone, one vector or an empty table give no rows. Equal rows get equal
    results, a row each; a null vec_id stays null; columns of other names are ignored.
    """
    good, x = whole_coordinates(F.col("_embedding"))
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].alias("_embedding")).where(good).select("vec_id", x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if not lengths or not lengths["d"]:
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    d = lengths["d"]
    rows = rows.where(F.size("x") == d)
    fit = FitList(stored(_blocks(rows.select("x").distinct(), d), "fit"), d)
    trace = fit.trace()
    if not trace > 0:
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    e, q = jacobi_davidson(fit.product, d, components)
    kept = e > d * EPS * e[0]
    e, q = e[kept], q[:, kept]
    project = q / np.sqrt(e)
    error = float(np.abs(fit.covariance_of(project) - np.eye(len(e))).max())
    n, sums, centred, k = fit.n, fit.sums, fit.centred(), len(e)
    explained, names = e / trace, [c.split()[0] for c in WHITENED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                m = part.num_rows
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, d)
                far = n * x - sums
                fits = np.square(far.astype(np.float64)).sum(1) < 9e18
                deviation = pa.array(np.square(far).sum(1), mask=~fits)
                by_row = np.repeat(np.arange(m), k)
                columns = [part.column(0).take(pa.array(by_row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation.take(pa.array(by_row))]
                columns += [pa.array((centred(x) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, WHITENED)
