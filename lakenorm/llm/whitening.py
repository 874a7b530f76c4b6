"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows are put on a grid of whole numbers, ``x = floor(64 c) + 1000000``, and
the fit list holds every distinct one once, as blocks in a written table. With X
the fit list minus its mean (a whole number over n, so nothing cancels), the
method makes orthonormal u and v with ``X v_k = a_k u_k + b_(k-1) u_(k-1)`` and
``X' u_k = a_k v_k + b_k v_(k+1)``. Singular values and right vectors of the
small bidiagonal matrix of a and b give the deviations and components of X.

One pass over the blocks does both products of a step: a task computes ``X q``
for its rows and adds up ``X' (X q)``, one number a dimension, which Spark sums.
The u have a component for every row, so they are never stored: u_k is ``X p_k``
with p_k as long as one vector, and inner products of u need ``X' X`` alone,
which the passes have given. All u and all v are reorthogonalised, twice each
step. A step that ends in an invariant space goes on from a new direction, so
repeated deviations are found as often as they occur. After as many steps as
dimensions the result is complete; ``steps`` stops earlier and the residuals
are then checked.

The driver and the tasks hold a few vectors of one row's length per step; a
lost executor costs the tasks of one pass.

Defined results: a null vector, one with null or non-finite entries or with an
entry beyond 2**52 on the grid takes no part and has no rows; vectors of another
length than most (of ties, the longest) take no part either; repeated rows count
once in the fit and each has its rows; ids may be null or repeat; a direction
without deviation (fewer distinct rows than dimensions, a constant entry) is no
component; fewer than two distinct vectors, an empty table or empty vectors give
no rows; a deviation beyond 64 bits is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, named, stage, table

GRID, SHIFT = 64, 1_000_000     # fixed values of the contract
COMPONENTS = 16
FLAT = 1e-7                     # a direction with less than this share of the whole deviation has none: it is rounding
BLOCK = 1024


def grid(src: DataFrame) -> DataFrame:
    """``src(id, vec)`` -> ``(id, x array<long>)``, rows that take no part left out."""
    on_grid = F.transform("vec", lambda c: F.floor(GRID * c.cast("double")))
    usable = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall(
        "vec", lambda c: F.coalesce(F.abs(GRID * c.cast("double")) < float(1 << 52), F.lit(False)))
    return src.where(usable).select("id", F.transform(on_grid, lambda g: g + F.lit(SHIFT).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def fit_blocks(x: DataFrame) -> DataFrame:
    """Every distinct row of ``x`` once, as blocks ``(rows, data)`` of 64-bit whole numbers."""
    def batches(it):
        for b in it:
            m = _matrix(b.column("x"))
            parts = [m[i:i + BLOCK] for i in range(0, len(m), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int64()),
                                              pa.array([p.tobytes() for p in parts], pa.binary())], ["rows", "data"])
    return stage(x.select("x").distinct().mapInArrow(batches, "rows long, data binary"), "whiten-fit")


def block_sums(blocks: DataFrame, dim: int, of, length: int, kind: str) -> np.ndarray:
    """Sum over all blocks of ``of(matrix of whole numbers)``, an array of ``length``."""
    def batches(it):
        total = None
        for b in it:
            for raw in b.column("data"):
                part = of(np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], ["j", "v"])

    rows = blocks.select("data").mapInArrow(batches, f"j long, v {kind}").groupBy("j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(length, np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r.j] = r.v
    return out


class Fit:
    """The fit list: blocks, number of rows and exact sums."""

    def __init__(self, x: DataFrame, dim: int):
        self.blocks, self.dim = fit_blocks(x), dim
        self.n = int(self.blocks.agg(F.sum("rows")).first()[0])
        self.sums = block_sums(self.blocks, dim, lambda m: m.sum(axis=0), dim, "long")

    def centred(self):
        """Function from whole numbers to rows minus the mean, in double precision."""
        n, sums = self.n, self.sums
        base = sums // n                    # whole part of the mean: what is left is small and exact
        left = (sums - base * n) / n
        return lambda m: (m - base).astype(np.float64) - left

    def product(self, q: np.ndarray) -> np.ndarray:
        """``X' (X q)`` in one pass; q is a vector or a matrix of columns."""
        centred, shape = self.centred(), q.shape

        def both(m):
            x = centred(m)
            return (x.T @ (x @ q)).ravel()
        return block_sums(self.blocks, self.dim, both, q.size, "double").reshape(shape)

    def trace(self) -> float:
        centred = self.centred()
        return float(block_sums(self.blocks, self.dim, lambda m: (centred(m) ** 2).sum(axis=0), self.dim, "double").sum())


def bidiagonalise(product, dim: int, steps: int, scale: float, seed: int = 13):
    """``product(q) = X'(X q)`` -> (V, alphas, betas): ``V`` has a column per
    step. ``scale`` is the largest deviation there can be."""
    rng = np.random.default_rng(seed)
    v_all, p_all, g_all = np.zeros((dim, 0)), np.zeros((dim, 0)), np.zeros((dim, 0))
    alphas, betas = [], []

    def against(v):
        for _ in range(2):
            v = v - v_all @ (v_all.T @ v)
        return v

    def fresh():
        v = against(rng.normal(size=dim))
        return v / np.linalg.norm(v)

    v = fresh()
    for k in range(steps):
        # u = X v - b u_before, as X q
        q = v - (betas[-1] * p_all[:, -1] if k else 0)
        z = product(q)
        for _ in range(2):                  # against all u, whose products with u are p'z
            c = p_all.T @ z
            q, z = q - p_all @ c, z - g_all @ c
        a = np.sqrt(max(q @ z, 0.0))
        v_all = np.column_stack([v_all, v])
        if a <= FLAT * scale:               # X v lies in the space of the u found
            a, p, g = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            p, g = q / a, z / a
        p_all, g_all = np.column_stack([p_all, p]), np.column_stack([g_all, g])
        alphas.append(a)
        if k + 1 == dim:
            betas.append(0.0)
            break
        w = against(g - a * v)
        b = np.linalg.norm(w)
        if b <= FLAT * scale:               # an invariant space: go on from a new direction
            b, v = 0.0, fresh()
        else:
            v = against(w / b)
            v /= np.linalg.norm(v)
        betas.append(float(b))
    return v_all, np.array(alphas), np.array(betas)


def principal(fit: Fit, components: int = COMPONENTS, steps: int | None = None):
    """(eigenvalues, vectors as columns, trace of V): unit eigenvectors of the
    covariance by falling eigenvalue, those without deviation left out."""
    squares = fit.trace()
    if not squares:
        return np.zeros(0), np.zeros((fit.dim, 0)), 0.0
    scale = np.sqrt(squares)
    k = min(fit.dim, steps or fit.dim)
    v, a, b = bidiagonalise(fit.product, fit.dim, k, scale)
    upper = np.diag(a) + np.diag(b[:len(a) - 1], 1)
    left, s, right = np.linalg.svd(upper)
    keep = np.flatnonzero(s > FLAT * scale)[:components]
    residual = b[-1] * np.abs(left[-1, keep])
    if len(keep) and residual.max() > 1e-9 * s[0]:
        raise ValueError(f"{k} steps leave a residual of {residual.max() / s[0]:.1e} of the largest deviation: allow more steps")
    vectors = np.linalg.qr(v @ right[keep].T)[0] if len(keep) else np.zeros((fit.dim, 0))
    return s[keep] ** 2 / fit.n, vectors, squares / fit.n


def identity_error(fit: Fit, values: np.ndarray, vectors: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, from its rows."""
    centred, m, turn = fit.centred(), len(values), vectors / np.sqrt(values)

    def second(x):
        w = centred(x) @ turn
        return (w.T @ w).ravel()
    cov = block_sums(fit.blocks, fit.dim, second, m * m, "double").reshape(m, m) / fit.n
    return float(np.abs(cov - np.eye(m)).max())


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           steps: int | None = None) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, a
    row per input row that takes part and component."""
    src = named(vectors, id=id_column, vec=vector)
    kind = src.schema["id"].dataType.simpleString()
    out_schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    bounded_batches(src.sparkSession)
    x = grid(src)
    most = x.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("dim")).first()
    if most is None:
        return src.sparkSession.createDataFrame([], out_schema)
    x = stage(x.where(F.size("x") == most.dim), "whiten-grid")
    fit = Fit(x, most.dim)
    values, axes, trace = principal(fit, components, steps)
    if not len(values):
        return src.sparkSession.createDataFrame([], out_schema)
    off, n, sums, m = identity_error(fit, values, axes), fit.n, fit.sums, len(values)
    centred, turn, explained = fit.centred(), axes / np.sqrt(values), values / trace

    def deviations(g: np.ndarray) -> pa.Array:
        d = centred(g) * n
        if (d ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
            return pa.array(((g * n - sums) ** 2).sum(axis=1))
        whole = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in g.tolist()]
        return pa.array([w if w < 1 << 63 else None for w in whole], pa.int64())

    def batches(it):
        for b in it:
            g = _matrix(b.column("x"))
            if not len(g):
                continue
            rows = len(g)
            take = pa.array(np.repeat(np.arange(rows), m))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * m, n)), deviations(g).take(take), pa.array((centred(g) @ turn).ravel()),
                 pa.array(np.tile(explained, rows)), pa.array(np.full(rows * m, off))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return x.mapInArrow(batches, out_schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
ORACLE: dict[str, str] = {}
