"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, ``x = floor(1024 * c) + 100000``; X are the centred rows.
Vectors are written once as blocks of rows. A step of the bidiagonalisation

    X v_j = beta_{j-1} u_{j-1} + alpha_j u_j,   X^T u_j = alpha_j v_j + beta_j v_{j+1}

is one pass over the blocks: every task forms its part of r = X q and of X^T r, and
one short record a task is summed. The long vectors are never stored: u_j = X p_j
with a short p_j, so a lost executor costs no state, and products with all earlier
u_i (full reorthogonalisation on the left) follow from X^T r and the kept X^T u_i. The
short v_j are reorthogonalised twice on the driver. The iteration ends when the wanted
singular triplets have converged and the variance not yet seen is too small to hide
another of their size, at the latest after as many steps as there are dimensions; after
a breakdown it goes on with a new direction, so equal singular values are all found.
The small bidiagonal matrix's SVD yields components and deviations.

What reaches the driver or one task does not grow with the rows: one record of d + 1 numbers
a task, and d x d numbers in the iteration. The order of the sums' terms does not matter
to about the last bit (compensated sums); counts, ``S`` and ``deviation`` are exact.

Defined results: rows whose vector is null or holds null or non-finite entries are left
out; vectors shorter than the longest count as filled up with zeros; x is limited to
+-2^62; a ``deviation`` beyond 64 bits is null. Rows may share a vec_id or have none, each
gives its own results. Components without variance do not exist: one vector, or equal
vectors only, give no rows, and so does an empty table. Each component's sign makes its
largest entry positive. Extra columns play no role.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spilled, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries of a block of vectors.
BLOCK_ENTRIES = 1 << 17
#: A deviation below this share of the largest one is rounding, not variance.
NOTHING = 1e-9
_LIMIT = 2.0**62
_EPS = float(np.finfo(float).eps)


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) without null vectors and null or non-finite entries."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & ~bad)


def blocks_of(rows: DataFrame, dims: int) -> DataFrame:
    """The usable rows as blocks (ids, x: int64 matrix as bytes), written once."""

    def pack(batches):
        step = max(1, BLOCK_ENTRIES // dims)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column("embedding")
                flat, sizes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(lists.value_lengths())
                c = np.zeros((part.num_rows, dims))
                c[np.arange(dims) < sizes[:, None]] = flat
                x = np.clip(np.floor(SCALE * c), -_LIMIT, _LIMIT).astype(np.int64) + SHIFT
                yield pa.RecordBatch.from_arrays([pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], names=["ids", "x"])

    return spilled(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(pack, "ids array<long>, x binary"))


def _matrices(batches, dims: int):
    for batch in batches:
        for ids, x in zip(batch.column("ids"), batch.column("x")):
            yield ids, np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dims)


def _exact(x: np.ndarray, bits: int) -> np.ndarray:
    """``x`` as Python integers where products of it would not fit 64 bits."""
    return x if x.size == 0 or max(int(x.max()), -int(x.min())) < 1 << bits else x.astype(object)


def _merge(total, part):
    """Sums of arrays: integers exactly, floats with a carried error."""
    out = []
    for (s, carry), v in zip(total, part):
        if s.dtype == object:
            out.append((s + v, carry))
        else:
            t = s + v
            out.append((t, carry + np.where(np.abs(s) >= np.abs(v), (s - t) + v, (v - t) + s)))
    return out


def totals(blocks: DataFrame, dims: int, part) -> list[np.ndarray] | None:
    """Sums over all blocks of the arrays that ``part(x)`` gives for each; None without blocks."""

    def record(sums):
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps([s if s.dtype == object else s + c for s, c in sums])], pa.binary())], names=["sums"])

    def each_task(batches):
        sums = None
        for _, x in _matrices(batches, dims):
            got = part(x)
            sums = _merge(sums or [(np.zeros_like(v), np.zeros(np.shape(v))) for v in got], got)
        if sums:
            yield record(sums)

    def together(batches):
        sums = None
        for batch in batches:
            for b in batch.column("sums").to_pylist():
                got = pickle.loads(b)
                sums = _merge(sums or [(np.zeros_like(v), np.zeros(np.shape(v))) for v in got], got)
        if sums:
            yield record(sums)

    row = blocks.select("x").withColumn("ids", F.lit(None).cast("array<long>")).mapInArrow(each_task, "sums binary").repartition(1).mapInArrow(together, "sums binary").first()
    return pickle.loads(row["sums"]) if row else None


def _moments(x: np.ndarray) -> list[np.ndarray]:
    """Row count, sums of the dimensions, sum of all squares, as exact integers."""
    y = _exact(x, 22)
    return [np.array([len(x)], object), np.array([int(v) for v in y.sum(axis=0)], object), np.array([int((y * y).sum())], object)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n; whole parts are subtracted exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    near = np.abs(x) < 1 << 61
    return np.where(near, np.where(near, x, 0) - whole, x.astype(float) - whole.astype(float)) - rest


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonalise(product, dims: int, total: float, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of X and their right vectors (columns).

    ``product(q)`` gives |X q|^2 and X^T X q; ``total`` is the sum of all squares of X.
    """
    rng = np.random.default_rng(12)

    def direction(basis):
        v = _orthogonal(rng.standard_normal(dims), basis)
        return v / np.linalg.norm(v)

    scale = math.sqrt(total)
    vs, ps, backs, alphas, betas = [direction([])], [], [], [], []
    while True:
        j = len(alphas)
        q = vs[j] - (betas[-1] * ps[-1] if j else 0)
        for _ in range(3):  # overlaps with the earlier u_i; again only where they were large
            norm2, back = product(q)
            overlap = np.array([p @ back for p in ps]) if ps else np.zeros(0)
            for h, p, t in zip(overlap, ps, backs):
                q, back = q - h * p, back - h * t
            left = norm2 - overlap @ overlap
            if overlap @ overlap <= 1e-20 * max(norm2, 0) or left <= (_EPS * scale) ** 2:
                break
        alpha = math.sqrt(max(left, 0))
        if alpha <= 1e-13 * scale:
            alphas.append(0.0), ps.append(np.zeros(dims)), backs.append(np.zeros(dims))
        else:
            alphas.append(alpha), ps.append(q / alpha), backs.append(back / alpha)
        w = _orthogonal(backs[-1] - alphas[-1] * vs[j], vs)
        beta = float(np.linalg.norm(w))
        b = np.diag(alphas) + np.diag(betas, 1)
        lefts, sigma, rights = np.linalg.svd(b)
        at = min(wanted, len(sigma)) - 1
        unseen = total - float((b * b).sum())
        done = len(sigma) >= wanted and unseen < sigma[at] ** 2 and (beta * np.abs(lefts[-1, : at + 1]) <= _EPS * sigma[0]).all()
        if done or j + 1 == dims:
            return sigma[: at + 1], np.array(vs).T @ rights[: at + 1].T
        if beta <= 1e-13 * scale:
            betas.append(0.0), vs.append(direction(vs))
        else:
            betas.append(beta), vs.append(w / beta)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), see the module."""
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = usable(rows)
    dims = fit.agg(F.max(F.size("embedding"))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], schema)
    blocks = blocks_of(fit, dims)
    (n,), sums, (squares,) = (list(v) for v in totals(blocks, dims, _moments))
    spread = n * squares - sum(s * s for s in sums)  # n times the sum of all squares of X
    if not spread:
        return spark.createDataFrame([], schema)
    total = spread / n

    def product(q):
        def part(x):
            r = centred(x, n, sums)
            u = r @ q
            return [np.array([u @ u]), r.T @ u]

        (norm2,), back = totals(blocks, dims, part)
        return float(norm2), back

    sigma, vectors = bidiagonalise(product, dims, total, components)
    kept = sigma > NOTHING * sigma[0]
    sigma, vectors = sigma[kept], vectors[:, kept]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(sigma))])
    to_white = vectors * (math.sqrt(n) / sigma)
    explained = sigma**2 / total

    def spread_of(x):
        w = centred(x, n, sums) @ to_white
        return [w.sum(axis=0), w.T @ w]

    mean, second = totals(blocks, dims, spread_of)
    covariance = second / n - np.outer(mean / n, mean / n)
    error = float(np.abs(covariance - np.eye(len(sigma))).max())

    def deviations(x):
        # whole numbers: 64 bits where they suffice, else Python's
        x = x.astype(object) if n * max(int(x.max()), -int(x.min())) >= 1 << 61 or max(map(abs, sums)) >= 1 << 61 else x
        t = n * x - np.array(sums, dtype=x.dtype)
        t = _exact(t, (62 - dims.bit_length()) // 2)
        return [v if v < 1 << 63 else None for v in map(int, (t * t).sum(axis=1))]

    def results(batches):
        k = len(sigma)
        for ids, x in _matrices(batches, dims):
            w = centred(x, n, sums) @ to_white
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids.as_py(), pa.int64()).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return blocks.mapInArrow(results, schema)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
