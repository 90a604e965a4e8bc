import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrid.operators.stats import exact_medians, exact_quantiles, prefix_sums


@pytest.mark.parametrize("buckets", [3, 512])
def test_exact_quantiles_match_numpy(spark, buckets):
    rng = np.random.default_rng(7)
    a = rng.normal(size=3001).round(2)  # many ties
    b = np.concatenate([np.full(1000, 3.0), rng.uniform(0, 10, 1000)])  # a third on one value
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, np.resize(b, len(a))))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = exact_quantiles(df, ["a", "b"], (0.25, 0.5, 0.75), buckets=buckets)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    for p in (0.25, 0.5, 0.75):
        assert got[("a", p)] == pytest.approx(np.quantile(a, p), abs=1e-12)
        assert got[("b", p)] == pytest.approx(np.quantile(bb, p), abs=1e-12)


def test_millions_of_distinct_values_in_few_rounds(spark, monkeypatch):
    """5 million distinct values over many orders of magnitude, half of the rows on one value,
    with few cut points: the rounds follow the logarithm of the rows."""
    from daygrid.operators import stats

    rounds = []
    ranges = stats._in_ranges
    monkeypatch.setattr(stats, "_in_ranges", lambda v, r: rounds.append(len(r)) or ranges(v, r))
    n = 5_000_000
    wide = F.exp((F.pmod(F.col("id") * 2_654_435_761, F.lit(n)) - n / 2) / (n / 600.0))
    df = spark.range(n).select(wide.alias("x"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id") - n / 2.0).alias("y"), (F.lit(5.0) + F.col("id") % 3).alias("z"))
    got = exact_quantiles(df, ["x", "y", "z"], (0.0, 0.3, 0.5, 1.0), buckets=32)
    x = np.exp((np.arange(n) - n / 2) / (n / 600.0))
    for p in (0.0, 0.3, 0.5, 1.0):
        assert got["x", p] == pytest.approx(np.quantile(x, p), rel=1e-9)
    assert got["y", 0.5] == 0.0 and got["y", 1.0] == n / 2 - 1 and got["z", 0.5] == 6.0
    assert len(rounds) <= 7 and max(rounds) <= 15


def test_exact_medians_even_odd_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "x double, y double")
    m = exact_medians(df, ["x", "y"], buckets=2)
    assert m["x"] == 2.5
    assert m["y"] is None


def test_prefix_sums_match_cumsum(spark):
    rows = [(i * 0.5, i % 3, (i * 7) % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "s double, a int, b int")
    out = prefix_sums(df, ["s"], ["a", "b"], ascending=False, partitions=7).orderBy(F.desc("s")).collect()
    ca = np.cumsum([r[1] for r in sorted(rows, key=lambda r: -r[0])])
    assert [r["a_cum"] for r in out] == list(ca)


def test_auc_and_prefix_sums_at_200_000_scores(spark):
    """Exact against a rank sum, for several groups, extra columns, any exchange reuse."""
    from daygrid.operators import evaluate as EV

    n = 200_000
    rng = np.random.default_rng(1)
    p, noise = rng.permutation(n) / n, rng.random(n)
    y = (noise < 0.2 + 0.3 * p).astype(int)
    group = np.array([None, "a", "b"], object)[rng.integers(0, 3, n)]
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame({"g": group, "p": p, "y": y, "extra": np.arange(n)})).repartition(7)
    exp = {}
    for g in (None, "a", "b"):
        own = np.array([x is g or x == g for x in group])
        order = np.argsort(p[own])
        pos = y[own][order] == 1
        ranks = np.flatnonzero(pos) + 1
        exp[g] = (ranks.sum() - len(ranks) * (len(ranks) + 1) / 2) / (len(ranks) * (own.sum() - len(ranks)))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, "y", "p", ["g"]).collect()}
            assert got == pytest.approx(exp, abs=1e-12)
            cum = prefix_sums(df, ["p"], ["y"], by=["g"], partitions=9).filter("g = 'a'").orderBy("p").toPandas()
            assert (cum["y_cum"] == cum["y"].cumsum()).all() and set(cum.columns) == {"g", "p", "y", "extra", "y_cum"}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
