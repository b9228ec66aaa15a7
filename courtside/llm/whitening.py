"""Embedding whitening by QDWH spectral divide-and-conquer.

Tasks add up whole numbers: sums of the quantised entries, then products of
entries from which the whole mean has been taken, so the covariance comes from
exact sums whatever the order of rows, and is rounded once. What reaches the driver is
that matrix, of a size given by the vectors' length alone.

There the covariance is split again and again: the QDWH iteration (dynamically
weighted Halley, by QR while badly conditioned, by Cholesky later) gives the
orthogonal polar factor of the covariance minus a shift; (I + factor) / 2 projects on the
invariant subspace of the eigenvalues above the shift, I minus that on the rest; the covariance
restricted to either subspace is split in turn until subspaces are lines or have one
eigenvalue. A few steps of iterative refinement bring the eigenvectors
to double precision. The components go to all tasks, which whiten their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import read

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries of this size times SCALE or more are refused: they are no embeddings.
LARGEST = 2.0 ** 52
EPS = np.finfo(float).eps


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric, regular matrix: its sign function."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low = min(1.0, max(1 / np.linalg.norm(np.linalg.inv(x)), EPS / 8))  # at most the least singular value
    eye = np.eye(n)
    for _ in range(20):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            x = q / r * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        else:
            w = np.linalg.cholesky(eye + r * x.T @ x)
            x = q / r * x + (p - q / r) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        x = (x + x.T) / 2
        low = min(1.0, low * (p + q * l2) / (1 + r * l2))
        if abs(low - 1) < 10 * EPS and np.linalg.norm(x - before) < np.cbrt(EPS):
            break
    return x


def _shift(a: np.ndarray, spread: float) -> float:
    """A number between eigenvalues, as far from all as the candidates allow.

    The mean of the eigenvalues lies between the least and the largest; so do the others tried.
    """
    mean, best, found = np.trace(a) / len(a), -1.0, 0.0
    for k in (0, 0.1, -0.1, 0.037, -0.037, 0.0113, -0.0113, 0.0031, -0.0031):
        sigma = mean + k * spread / len(a)
        try:
            gap = 1 / np.linalg.norm(np.linalg.inv(a - sigma * np.eye(len(a))))
        except np.linalg.LinAlgError:
            continue
        if gap > 1e-3 * spread / len(a):
            return sigma
        if gap > best:
            best, found = gap, sigma
    return found


def split(a: np.ndarray, size: float) -> list[np.ndarray]:
    """Orthonormal bases whose columns are eigenvectors of the symmetric matrix ``a``."""
    n = len(a)
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if n == 1 or spread <= 4 * n * EPS * size:  # a line, or one eigenvalue
        return [np.eye(n)]
    up = (polar_sign(a - _shift(a, spread) * np.eye(n)) + np.eye(n)) / 2
    above = int(round(np.trace(up)))
    if not 0 < above < n:  # eigenvalues too close to tell apart
        return [np.eye(n)]
    noise = np.random.default_rng(n).standard_normal((n, n))
    out = []
    for projector, rank in ((up, above), (np.eye(n) - up, n - above)):
        basis = np.linalg.qr(projector @ noise[:, :rank])[0]
        basis = np.linalg.qr(projector @ basis)[0]
        inner = basis.T @ a @ basis
        out += [basis @ part for part in split((inner + inner.T) / 2, size)]
    return out


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and orthonormal eigenvectors (columns) of a symmetric matrix."""
    size = float(np.linalg.norm(a))
    x = np.hstack(split(a, size)).astype(np.longdouble)
    exact, eye = a.astype(np.longdouble), np.eye(len(a))
    for _ in range(3):  # refinement: errors are squared in each step
        rest, inner = eye - x.T @ x, x.T @ exact @ x
        values = np.diag(inner) / (1 - np.diag(rest))
        close = 2 * (np.linalg.norm((inner - np.diag(values)).astype(float), 2)
                     + size * np.linalg.norm(rest.astype(float), 2))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > close
        x = x + x @ np.where(apart, (inner + values[None, :] * rest) / np.where(apart, gaps, 1), rest / 2)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(float), x[:, order].astype(float)


@dataclass
class Whitening:
    """Components of a fit list of ``n`` vectors."""

    n: int
    shift: list[int]            # whole means of the quantised entries
    sums: list[int]             # sums of the entries less these
    matrix: np.ndarray          # a column a component, over the root of its eigenvalue
    explained: list[float]
    identity_error: float = 0.0


def quantised(vectors: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000 - shift of each entry, as 64-bit integers."""
    scaled = SCALE * vectors.astype(np.float64)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"an entry of an embedding is {LARGEST / SCALE} or more")
    return np.floor(scaled).astype(np.int64) + (OFFSET - shift)


def _products(z: np.ndarray) -> np.ndarray:
    """z.T @ z in whole numbers (Python's)."""
    largest = int(np.abs(z).max()) if z.size else 0
    if largest * largest * len(z) < 1 << 53:  # all sums are whole in floating point
        f = z.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if len(z) > 1:
        return _products(z[:len(z) // 2]) + _products(z[len(z) // 2:])
    return np.outer(z[0].astype(object), z[0].astype(object))


def _matrices(batches: Iterator[pa.RecordBatch], column: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(vectors: DataFrame, dims: int, kernel) -> list[int]:
    """Sums, place by place, of the whole numbers that ``kernel`` gives for each matrix of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, m in _matrices(batches, 0, dims):
            found = kernel(m)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]], pa.list_(pa.string()))], names=["v"])

    parts = vectors.select("embedding").mapInArrow(run, "v array<string>")
    rows = parts.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # a row for each place, not for data
    out = [0] * len(rows)
    for r in rows:
        out[r.i] = int(r.v)
    return out


def fit_list(embeddings: DataFrame) -> tuple[DataFrame, int, int]:
    """vec_id and embedding of the whole vectors, how many they are, and their length.

    Whole: no null and no entry that is null or not finite; of the commonest length (of those the largest).
    """
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = embeddings.select("vec_id", "embedding").where(sound & (F.size("embedding") > 0))
    size = F.size("embedding")
    top = whole.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims, n = (top["d"], top["count"]) if top else (0, 0)
    return whole.where(size == dims), n, dims


def fit(vectors: DataFrame, n: int, dims: int, components: int = COMPONENTS) -> Whitening:
    zero = np.zeros(dims, np.int64)
    total = _summed(vectors, dims, lambda m: quantised(m, zero).sum(axis=0).astype(object))
    shift = [s // n for s in total]
    near, sums = np.array(shift, np.int64), [s - n * m for s, m in zip(total, shift)]
    upper = np.triu_indices(dims)
    products = _summed(vectors, dims, lambda m: _products(quantised(m, near))[upper])
    covariance = np.empty((dims, dims))
    for i, j, v in zip(*upper, products):
        covariance[i, j] = covariance[j, i] = float(Fraction(n * v - sums[i] * sums[j], n * n))
    values, axes = eigenvectors(covariance)
    kept = values > 8 * dims * EPS * max(values[0], 0)  # without variance nothing can be whitened
    values, axes = values[kept][:components], axes[:, kept][:, :components]
    model = Whitening(n, shift, sums, axes / np.sqrt(values), [float(v) for v in values / np.trace(covariance)])
    if len(values):
        model.identity_error = _identity_error(vectors, model, dims)
    return model


def _centred(m: np.ndarray, model: Whitening) -> np.ndarray:
    """n times each quantised entry less its mean, as whole numbers."""
    z = quantised(m, np.array(model.shift, np.int64))
    if model.n * (int(np.abs(z).max()) + 1) >= 1 << 62:
        z = z.astype(object)
    return model.n * z - np.array(model.sums, z.dtype)


def _whitened(m: np.ndarray, model: Whitening) -> np.ndarray:
    return (_centred(m, model) / model.n).astype(float) @ model.matrix


def _identity_error(vectors: DataFrame, model: Whitening, dims: int) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, from all vectors."""
    shared, k = vectors.sparkSession.sparkContext.broadcast(model), model.matrix.shape[1]  # dims x components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, m in _matrices(batches, 0, dims):
            w = _whitened(m, shared.value)
            total += w.T @ w  # the mean of whitened vectors is zero
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])

    rows = vectors.select("embedding").mapInArrow(run, "v array<double>").select(
        F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()  # k * k rows
    covariance = np.zeros(k * k)
    for r in rows:
        covariance[r.i] = r.v / model.n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    A row for each whole vector and component. Defined cases: null vectors, and
    those with a null, infinite or undefined entry, are left out, as are empty ones and
    those of another length than most; rows with equal or null ids are
    whitened row by row; components without variance (all vectors equal, or
    fewer vectors than dimensions) are left out, so one vector alone gives no rows,
    nor does an empty table; entries of 2**46 or more, and deviations beyond 64
    bits, are errors. Other columns are not read.
    """
    vectors, n, dims = fit_list(embeddings)
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    model = fit(vectors, n, dims, components) if n else None
    out = f"vec_id {id_type}, deviation bigint, whitened array<double>"
    if model is None or not model.explained:
        rows, explained, error = embeddings.sparkSession.createDataFrame([], out), [0.0], 0.0
    else:
        shared, explained, error = embeddings.sparkSession.sparkContext.broadcast(model), model.explained, model.identity_error

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, m in _matrices(batches, 1, dims):
                far = _centred(m, shared.value)
                if int(np.abs(far).max()) ** 2 * dims >= 1 << 63:
                    far = far.astype(object)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array((far * far).sum(axis=1).tolist(), pa.int64()),
                     pa.array(list(_whitened(m, shared.value)), pa.list_(pa.float64()))],
                    names=["vec_id", "deviation", "whitened"])

        rows = vectors.mapInArrow(run, out)
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, explained)), F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
