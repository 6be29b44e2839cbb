"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows form a tall matrix A that stays on the executors.  One step takes the
product z = A y and, in the same pass over the rows, z's products with the left vectors so
far and A^T z; sums of a few hundred numbers come back.  A left vector is never stored: it is
A times a short vector of coefficients, which the driver holds, so nothing as long as the
table is written between steps and a lost task is simply run again.  Left and right vectors
are reorthogonalised in full.  The small bidiagonal matrix's singular vectors and values give
the components and their deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import written

COMPONENTS = 4
#: Entries become ``floor(SCALE * entry)``.
SCALE = 256
#: Rows of a batch that are turned into numbers at a time.
AT_ONCE = 16_384
#: Vectors shorter than this part of the matrix's norm are rounding errors.
NOTHING = 1e-13
#: Products that are not orthogonal by more than this are made so once more.
AGAIN = 1e-10


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``rows`` whose vector is whole (not null, not empty, all entries finite), with ``x``,
    its entries times ``scale``, rounded down, as longs."""
    v = F.col(vector)
    whole = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(F.coalesce(whole, F.lit(False))).withColumn("x", F.transform(v, lambda c: F.floor(c.cast("double") * scale)))


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches and their ``x`` as a matrix of longs."""
    for batch in batches:
        for low in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(low, AT_ONCE)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(fit: DataFrame, dims: int, of) -> np.ndarray:
    """The sum over all batches of the short vectors ``of(matrix)``, added up on the executors."""

    def run(batches):
        total = None
        for _, x in _matrices(batches, dims):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "v"])

    rows = fit.select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    return np.array([r["v"] for r in rows])


@dataclass
class Whitening:
    """``n`` fitted vectors, their ``sums`` by dimension, ``components`` as columns, the
    eigenvalue of each, all of V's eigenvalues in sum, and how far the result is from white."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return self.sums.astype(np.float64) / self.n

    def white(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.eigenvalues)


def bidiagonalise(fit: DataFrame, mean: np.ndarray, norm: float, steps: int | None = None, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and the upper bidiagonal matrix of the centred rows of ``fit``.

    By default as many steps as dimensions, after which nothing is left out, eigenvalues met
    several times included: where a vector comes to nothing, the next right vector is a
    random one orthogonal to those so far.
    """
    dims = len(mean)
    rng = np.random.default_rng(seed)

    def fresh(right: np.ndarray) -> np.ndarray:
        v = rng.standard_normal(dims)
        for _ in range(2):
            v -= right @ (right.T @ v)
        return v / np.linalg.norm(v)

    right, left = fresh(np.zeros((dims, 0)))[:, None], np.zeros((dims, 0))
    images = np.zeros((dims, 0))      # A^T u of the left vectors u
    alphas, betas = [], []
    beta = 0.0
    for step in range(min(steps or dims, dims)):
        y = right[:, -1] - (beta * left[:, -1] if step else 0.0)
        alpha, image = 0.0, np.zeros(dims)
        for _ in range(3):
            def products(x, y=y, left=left):
                a = x - mean
                z = a @ y
                return np.concatenate([[z @ z], (a @ left).T @ z, a.T @ z])

            got = _sums(fit, dims, products)
            length, off, image = np.sqrt(got[0]), got[1:1 + left.shape[1]], got[1 + left.shape[1]:]
            y = y - left @ off
            image = image - images @ off
            alpha = np.sqrt(max(got[0] - off @ off, 0.0))
            if alpha <= NOTHING * norm or np.abs(off).max(initial=0.0) <= AGAIN * length:
                break
        if alpha <= NOTHING * norm:
            alpha, y, image = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            y, image = y / alpha, image / alpha
        left, images = np.column_stack([left, y]), np.column_stack([images, image])
        alphas.append(alpha)
        if step + 1 < min(steps or dims, dims):
            v = image - alpha * right[:, -1]
            for _ in range(2):
                v -= right @ (right.T @ v)
            beta = np.linalg.norm(v)
            if beta <= NOTHING * norm:
                beta, v = 0.0, fresh(right)
            else:
                v /= beta
            right = np.column_stack([right, v])
            betas.append(beta)
    return right, np.diag(alphas) + np.diag(betas, 1)


def fit(vectors: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """The whitening of ``vectors`` (column ``x`` of longs), each distinct vector once.

    Vectors of another length than the most usual one (the shortest of equally usual ones)
    take no part.  There are as many components as asked for, or as the vectors' rank.  None
    where there is no vector or all are equal.  Eigenvectors are unique where eigenvalues
    differ; each has the sign that makes its largest entry positive.
    """
    lengths = vectors.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    if lengths is None:
        return None
    dims = lengths["dims"]
    # equal vectors meet after a partial aggregation, so a vector that most rows have is no hot key
    rows = written(vectors.where(F.size("x") == dims).select("x").distinct())
    totals = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    n, sums = totals[0]["n"], np.array([int(r["s"]) for r in totals], dtype=object)
    model = Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0)
    mean = model.mean
    model.trace = float(_sums(rows, dims, lambda x: ((x - mean) ** 2).sum(axis=0)).sum() / n)
    if model.trace <= 0.0:
        return None
    right, small = bidiagonalise(rows, mean, np.sqrt(model.trace * n), steps)
    _, deviations, turns = np.linalg.svd(small)
    most = min(components, int((deviations > 1e-10 * deviations[0]).sum()))
    found = right @ turns[:most].T
    found /= np.linalg.norm(found, axis=0)
    found *= np.where(found[np.abs(found).argmax(axis=0), np.arange(most)] < 0, -1.0, 1.0)
    model.components, model.eigenvalues = found, deviations[:most] ** 2 / n
    centre = _sums(rows, dims, lambda x: model.white(x).sum(axis=0)) / n

    def spread(x):
        w = model.white(x) - centre
        return (w.T @ w).ravel()

    model.identity_error = float(np.abs(_sums(rows, dims, spread).reshape(most, most) / n - np.eye(most)).max())
    return model


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Of each row the sum over dimensions of ``(n * x - sums) ** 2``, exact; None beyond a long."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(abs(int(s)) for s in sums)
    if most * most * len(sums) < 1 << 63:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           steps: int | None = None, key: str = "vec_id") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for each
    row of ``rows`` with a whole vector and each component.

    Rows whose vector is null, empty or holds null or non-finite entries are left out, and so
    are vectors of another than the usual length.  Repeated vectors count once in the fit and
    have a row each in the result; a null key stays null.  An empty table, and one in which all vectors are equal, gives an
    empty result.  Other columns are left out.
    """
    kept = integer_vectors(rows, vector, scale).select(F.col(key).cast("long").alias("key"), "x")
    model = fit(kept, components, steps)
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims, most = model.components.shape

    def project(batches):
        for part, x in _matrices(batches, dims):
            each, rank = len(x), np.arange(most)
            yield pa.RecordBatch.from_arrays([
                part.column("key").take(pa.array(np.repeat(np.arange(each), most))), pa.array(np.tile(rank + 1, each).astype(np.int32)),
                pa.array(np.full(each * most, model.n)), pa.array([d for d in deviations(x, model.n, model.sums) for _ in rank], pa.int64()),
                pa.array(model.white(x).ravel()), pa.array(np.tile(model.eigenvalues / model.trace, each)),
                pa.array(np.full(each * most, model.identity_error))], names=names)

    return kept.where(F.size("x") == dims).mapInArrow(project, schema)
