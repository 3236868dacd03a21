"""Whitening of vectors along their leading principal components, by Golub-Kahan-Lanczos bidiagonalisation.

Each entry c becomes the integer x = floor(256 c). The components are fitted on the distinct x-vectors. With A the
matrix of their centred rows, the recurrence

    u_j = (A v_j - beta_(j-1) u_(j-1)) / alpha_j,     v_(j+1) = (A'u_j - alpha_j v_j) / beta_j

makes A V = U B with a small upper bidiagonal B, whose SVD gives the components (V times its right vectors) and the
deviations. Every u is kept as the coefficients c of u = A c, which are as short as a row, and evaluated row by row where
A is: so one pass over the stored rows, A'(A c) and |A c|, makes a step, nothing as long as the table is ever held, and
a lost executor repeats its part of one pass. Both sides are orthogonalised against all earlier vectors, twice; the
products U'A v that this needs are those of the stored A'u. A recurrence that ends early (beta = 0) starts again from a new
direction, so that repeated eigenvalues are found as often as they occur.

Rows whose vector is null, holds a null or a non-finite entry, or has another length than most vectors (the longer of
equally frequent lengths) take no part and give no row. Null and repeated ids are kept as they are, one set of rows each.
A table without variation, or with less of it than components wanted, gives the components there are, and an empty
table none. Other columns do not matter, whatever their names. Entries beyond 2^45 are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.session import stage

SCALE = 256
BLOCK = 2048  # rows of a stored block
MAX_STEPS = 160  # enough to exhaust vectors of as many dimensions
RESIDUAL = 1e-12  # of the largest singular value, which longer vectors must get below by then
NEGLIGIBLE = 1e-11  # of the largest singular value: no variation at all
LARGEST = float(1 << 45)
SEED = 20_231


def integers(vectors: DataFrame, id_column: str, vector_column: str, *others: Column) -> DataFrame:
    """Rows (id, x and the other columns asked for) that take part, x an array of longs."""
    e = F.col(f"`{vector_column}`").cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    kept = vectors.select(F.col(f"`{id_column}`").alias("id"), *others, e.alias("e"))
    sound = kept.where(F.coalesce(F.forall("e", finite) & (F.size("e") > 0), F.lit(False)))
    lengths = sound.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()

    def whole(v: Column) -> Column:
        n = F.floor(v * SCALE)
        return F.when(F.abs(v) < LARGEST, n.cast("long")).otherwise(F.raise_error(F.lit("a vector entry is too large")).cast("long"))

    usual = sound.where(F.size("e") == lengths[0].d) if lengths else sound.where(F.lit(False))
    return usual.withColumn("x", F.transform("e", whole)).drop("e")


def _rows(column: pa.Array) -> np.ndarray:
    """A list column with lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fit:
    """The distinct x-vectors as blocks in the shared folder, their number and sums, and passes over them."""

    def __init__(self, x: DataFrame):
        def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in stream:
                for at in range(0, batch.num_rows, BLOCK):
                    rows = _rows(batch["x"].slice(at, BLOCK))
                    sums = pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([rows.astype("<i8").tobytes()], pa.binary()), pa.array([len(rows)], pa.int64()), sums], ["x", "n", "sums"])

        self.blocks = stage(x.select("x").distinct().mapInArrow(pack, "x binary, n long, sums array<long>"), "whitening")
        # Sums of integers, exact in any order; they have as many digits as they need.
        totals = self.blocks.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
        self.n = int(totals[0].n) if totals else 0
        self.sums = [int(r.s) for r in sorted(totals, key=lambda r: r.i)]
        self.d = len(self.sums)
        self.mean = np.array([s / self.n for s in self.sums])

    def reduce(self, of, size: int) -> np.ndarray:
        """Sum over all centred blocks of ``of(block)``, ``size`` numbers; a partition gives one partial sum."""
        mean, d = self.mean, self.d

        def partial(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in stream:
                for block in batch["x"]:
                    total += of(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, d) - mean)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["t"])

        parts = self.blocks.select("x").mapInArrow(partial, "t array<double>")
        found = parts.select(F.posexplode("t").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(size)
        for r in found:
            out[r.i] = r.v
        return out


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):  # once more takes away what rounding left
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(fit: Fit, max_steps: int = MAX_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """V (d x k), B (k x k) and what of A'U is left outside V after k steps, which is zero if V spans the space."""
    d, k = fit.d, min(fit.d, max_steps)
    chance = np.random.default_rng(SEED)
    v = np.zeros((d, k))
    c, z = np.zeros((d, k)), np.zeros((d, k))  # u_j = A c_j, and A'u_j
    b = np.zeros((k, k))
    following, largest, left = chance.standard_normal(d), 0.0, 0.0
    for j in range(k):
        v[:, j] = following / np.linalg.norm(following)
        # A v_j less its share of all earlier u: U'A v_j = (A'U)'v_j, so no further pass is needed.
        p = v[:, j].copy()
        for _ in range(2):
            p -= c[:, :j] @ (z[:, :j].T @ p)

        def product(block: np.ndarray, p: np.ndarray = p) -> np.ndarray:
            u = block @ p
            return np.append(block.T @ u, u @ u)

        found = fit.reduce(product, d + 1)
        alpha = float(np.sqrt(max(found[d], 0.0)))
        largest = max(largest, alpha)
        if alpha > NEGLIGIBLE * largest and largest > 0:
            c[:, j], z[:, j], b[j, j] = p / alpha, found[:d] / alpha, alpha
        # else A v_j lies in the span of the earlier u, and there is no u_j
        following = _orthogonal(z[:, j], v[:, : j + 1])
        beta = float(np.linalg.norm(following))
        largest, left = max(largest, beta), beta
        if j + 1 == k:
            break
        if beta > NEGLIGIBLE * largest:
            b[j, j + 1] = beta
        else:  # an invariant space: go on in a direction outside it
            following, left = _orthogonal(chance.standard_normal(d), v[:, : j + 1]), 0.0
    return v, b, 0.0 if k == d else left


def components(fit: Fit, n_components: int, max_steps: int = MAX_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit eigenvectors of the covariance as columns, their eigenvalues, falling, and the covariance's trace."""
    if fit.n < 2:
        return np.zeros((fit.d, 0)), np.zeros(0), 0.0
    v, b, left = bidiagonalise(fit, max_steps)
    outer, sigma, inner = np.linalg.svd(b)
    keep = int((sigma[:n_components] > NEGLIGIBLE * max(sigma[0], 1e-300)).sum())
    if left * np.abs(outer[-1, :keep]).max(initial=0.0) > RESIDUAL * sigma[0]:
        raise ValueError(f"{len(b)} steps leave the components inexact: allow more steps")
    trace = float(fit.reduce(lambda block: np.array([np.square(block).sum()]), 1)[0]) / fit.n
    return v @ inner[:keep].T, np.square(sigma[:keep]) / fit.n, trace


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null where 64 bits do not hold it."""
    if x.shape[1] * (n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))) ** 2 < 1 << 63:
        return np.square(n * x - np.array(sums)).sum(axis=1).tolist()
    exact = np.square(n * x.astype(object) - np.array(sums, object)).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", n_components: int = 4, max_steps: int = MAX_STEPS
) -> DataFrame:
    """Per row that takes part and component: id, component, n, deviation, whitened, explained, identity_error.

    ``n`` is the number of fitted vectors, ``deviation`` the exact sum of (n x - S)^2 over dimensions, ``whitened`` the
    projection of x - S / n over the component's deviation, ``explained`` the eigenvalue's share of the trace, and
    ``identity_error`` how far the whitened fit's covariance is from the identity at most.
    """
    rows = integers(vectors, id_column, vector_column)
    fit = Fit(rows)
    schema = f"id {vectors.schema[id_column].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    axes, values, trace = components(fit, n_components, max_steps) if fit.n else (np.zeros((0, 0)), np.zeros(0), 0.0)
    k = len(values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    scaled, mean, sums, n = axes / np.sqrt(values), fit.mean, fit.sums, fit.n

    def spread(block: np.ndarray) -> np.ndarray:
        w = block @ scaled
        return np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])

    found = fit.reduce(spread, k * k + k) / n
    error = float(np.abs(found[: k * k].reshape(k, k) - np.outer(found[k * k :], found[k * k :]) - np.eye(k)).max())
    explained = values / trace

    def project(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _rows(part["x"])
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"].take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)),
                        pa.array(_deviations(x, n, sums), pa.int64()).take(each),
                        pa.array(((x - mean) @ scaled).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)
