"""Whitening against an eigendecomposition of the covariance, and odd rows."""

import numpy as np
import pytest

from daygrid.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Covariance, its eigenpairs and exact deviations from the rows themselves."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s).astype(float) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)
    deviation = {i: int(((n * row - s) ** 2).sum()) for (i, _), row in zip(kept, x)}
    return [i for i, _ in kept], centred, values[order], vectors[:, order], np.trace(cov), deviation


def check(got, rows, components=8):
    ids, centred, values, vectors, trace, deviation = brute(rows)
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(ids) * k
    white = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(1, k + 1):
        exp = centred @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        out = np.array([white[i, c]["whitened"] for i in ids])
        exp = exp * np.sign(exp @ out)
        assert np.allclose(out, exp, atol=1e-7), c
        for i in ids:
            r = white[i, c]
            assert r["deviation"] == deviation[i] and r["n"] == len(ids)
            assert abs(r["explained"] - values[c - 1] / trace) <= 1e-10 and r["identity_error"] <= 1e-9


@pytest.mark.parametrize("shape", [(300, 20), (40, 30), (9, 12), (500, 3), (60, 1)])
def test_against_eigendecomposition(spark, shape):
    rng = np.random.default_rng(sum(shape))
    v = (rng.normal(size=shape) * np.linspace(1, 0.2, shape[1])).astype(np.float32)
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    check(whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect(), rows)


def test_given_embeddings(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(whitening.op12(spark, sf).collect(), [(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_equal_deviations_are_all_found(spark):
    """Four axes with the same variance: a single Krylov space holds one of them only."""
    rows = [(2 * a + (s > 0), [float(s) if b == a else 0.0 for b in range(4)]) for a in range(4) for s in (-1, 1)]
    got = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert len(got) == 8 * 4 and all(abs(r["explained"] - 0.25) < 1e-9 and r["identity_error"] < 1e-9 for r in got)


def test_bidiagonalisation_stops_early():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 60)) * np.concatenate([np.linspace(1e4, 4e3, 9), np.full(51, 1.0)])
    calls = []

    def product(q):
        calls.append(1)
        return float((x @ q) @ (x @ q)), x.T @ (x @ q)

    sigma, vectors = whitening.bidiagonalise(product, 60, float((x * x).sum()))
    assert len(calls) < 60
    assert np.allclose(sigma, np.linalg.svd(x)[1][:8], rtol=1e-12)
    assert np.allclose(np.linalg.norm(x @ vectors, axis=0), sigma, rtol=1e-12)


def test_odd_rows(spark):
    big = [1e30, -1e30, 5.0]
    rows = [(1, [0.5, 0.25, 1.0]), (1, [0.5, 0.25, 1.0]), (2, None), (3, [None, 1.0, 2.0]), (4, [float("nan"), 0.0, 0.0]), (5, [float("-inf"), 0.0, 0.0]), (None, [0.0, 1.0, 0.0]), (6, [1.0]), (7, [])]
    from pyspark.sql import functions as F

    extra = {n: F.lit("clash") for n in ("ids", "x", "n", "sums", "component", "whitened")}
    got = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumns(extra)).collect()
    filled = [(i, (v + [0.0] * 3)[:3]) for i, v in rows if v is not None and i not in (3, 4, 5)]
    ids, centred, values, vectors, trace, _ = brute(filled)
    assert {r["n"] for r in got} == {5} and len(got) == 5 * 3
    assert sorted({(r["vec_id"] is None, r["vec_id"] or 0) for r in got}) == [(False, 1), (False, 6), (False, 7), (True, 0)]
    assert all(r["identity_error"] < 1e-9 for r in got)
    whitening.whiten(spark.createDataFrame([(9, big, 0), (10, [1.0, 2.0, 3.0], 0)], SCHEMA)).collect()
    for few in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)], [(1, [], 0)]):
        assert whitening.whiten(spark.createDataFrame(few, SCHEMA)).collect() == []


def test_exact_beyond_64_bits():
    x = np.array([[2**40, 5], [-(2**40), 7]], dtype=np.int64)
    (n,), sums, (squares,) = whitening._moments(x)
    assert squares == 2 * 2**80 + 74 and list(sums) == [0, 12]
