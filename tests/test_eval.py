"""Split, feature preparation and evaluation against brute-force references."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrid.operators import evaluate as EV
from daygrid.operators import features as FE
from daygrid.operators.split import split_bounds, temporal_split


def brute_auc(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    rows = []
    for g in ("a", "b", "c"):
        for i in range(150):
            y = int(rng.random() < 0.3)
            p = float(np.round(rng.random() * 0.5 + 0.3 * y, 2))  # ties on purpose
            rows.append((g, y if g != "c" else 0, p))
    return rows, spark.createDataFrame(rows, "g string, y int, p double")


def test_auc_matches_brute_force(scored):
    rows, df = scored
    got = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, "y", "p", ["g"]).collect()}
    for g in ("a", "b", "c"):
        ys = [r[1] for r in rows if r[0] == g]
        ps = [r[2] for r in rows if r[0] == g]
        exp = brute_auc(ys, ps)
        assert (got[g] is None and exp is None) or got[g] == pytest.approx(exp, abs=1e-12)


def test_metrics_sweep_and_report(scored):
    rows, df = scored
    m = {r["g"]: r for r in EV.classification_metrics(df, "y", "p", ["g"]).collect()}
    a = [(y, int(p >= 0.5)) for g, y, p in rows if g == "a"]
    tp = sum(1 for y, q in a if y == 1 and q == 1)
    fp = sum(1 for y, q in a if y == 0 and q == 1)
    fn = sum(1 for y, q in a if y == 1 and q == 0)
    assert (m["a"]["tp"], m["a"]["fp"], m["a"]["fn"]) == (tp, fp, fn)
    assert m["a"]["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert m["c"]["precision"] == 0.0 and m["c"]["recall"] == 0.0  # no positives: zero_division = 0
    sweep = EV.threshold_sweep(df, "y", "p", ["g"])
    assert sweep.filter(F.col("g") == "a").count() == 37
    best = {r["g"]: r for r in EV.best_threshold(sweep, ["g"]).collect()}
    a_sweep = [(r["threshold"], r["f1"]) for r in sweep.filter(F.col("g") == "a").orderBy("threshold").collect()]
    top = max(f for _, f in a_sweep)
    assert best["a"]["best_threshold"] == min(t for t, f in a_sweep if f == top)
    rep = EV.class_report(df.withColumn("pred", EV.predict(F.col("p"))), "y", "pred", ["g"])
    assert rep.filter(F.col("g") == "a").count() == 4


def test_roc_curve_monotone(scored):
    _, df = scored
    pts = EV.roc_curve(df.filter(F.col("g") == "a"), "y", "p").collect()
    pts = sorted(pts, key=lambda r: (r["threshold"] is not None, -(r["threshold"] or 0)))
    assert (pts[0]["fpr"], pts[0]["tpr"]) == (0.0, 0.0)
    assert (pts[-1]["fpr"], pts[-1]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(pts, pts[1:]))


def test_temporal_split_sizes(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(20)]
    df = spark.createDataFrame([(d, k) for d in days for k in ("x", "y")], "date date, k string")
    b = split_bounds(df).first()
    assert (b["n_days"], b["first_validation_day"], b["first_test_day"]) == (20, days[14], days[17])
    counts = {r["split"]: r["count"] for r in temporal_split(df).groupBy("split").count().collect()}
    assert counts == {"train": 28, "validation": 6, "test": 6}
    few = spark.createDataFrame([(d,) for d in days[:5]], "date date")
    with pytest.raises(Exception):
        split_bounds(few).collect()


def test_oversample_exact_size_and_weights(spark):
    rows = [(i, int(i % 10 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, flood_next_24h int").repartition(7)
    over, sizes = FE.oversample_minority(df)
    got = {r[0]: r[1] for r in over.groupBy("flood_next_24h").count().collect()}
    assert got == {0: 900, 1: 900} and sizes["extra"] == 800
    assert over.filter("flood_next_24h = 1").select("id").distinct().count() <= 100
    w, used = FE.balanced_weights(df)
    assert used and w[1] == pytest.approx(1000 / (2 * 100)) and w[0] == pytest.approx(1000 / (2 * 900))


def test_train_medians_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0), (10.0, None)], "a double, b double")
    med = FE.train_medians(df, ["a", "b"])
    assert med == {"a": 2.0, "b": 5.0}
    stats = FE.scaling_stats(FE.impute(df, med), ["a", "b"])
    vals = np.array([1.0, 2.0, 2.0, 10.0])
    assert stats["a"] == pytest.approx((vals.mean(), vals.std()))
    assert stats["b"] == (5.0, 1.0)  # constant column scales by 1
