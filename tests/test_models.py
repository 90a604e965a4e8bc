"""Classifiers on planted signals, and models applied after being saved."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from daygrid.operators import evaluate as EV
from daygrid.operators import features as FE
from daygrid.operators import models as MD
from daygrid.plans import pipelines as PL


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = (rng.random(600) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - 2.0 * x[:, 1] + 0.3)))).astype(int)
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, `c d` double, flood_next_24h int")


def newton(x, y, w, C):
    """L2 logistic regression with a free intercept: C * sum(w * loss) + |b|^2 / 2."""
    z = np.column_stack([x, np.ones(len(x))])
    b, penalty = np.zeros(z.shape[1]), np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ b))
        b = b - np.linalg.solve(C * (z.T * (w * p * (1 - p))) @ z + penalty, C * z.T @ (w * (p - y)) + penalty @ b)
    return b


@pytest.mark.parametrize("C", [1.0, 0.01])
def test_logistic_coefficients_against_an_independent_solver(planted, C):
    x, y, df = planted
    weights, _ = FE.balanced_weights(df, threshold=1.1)
    w = np.array([weights[int(t)] for t in y])
    model = MD.fit_logistic(FE.with_weights(df, weights), ["a", "b", "c d"], C=C)
    exp = newton(x, y, w, C)
    assert np.allclose([*model.coefficients, model.intercept], exp, atol=2e-4)
    scored = MD.score(model, df, ["a", "b", "c d"]).toPandas()
    assert np.allclose(scored["p"], 1 / (1 + np.exp(-(x @ exp[:3] + exp[3]))), atol=1e-4)
    assert ((scored["p"] >= 0.5).astype(int) == scored["pred"]).all()


def test_network_learns_what_a_line_cannot_and_repeats(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, size=(500, 2))
    rows = [(float(a), float(b), int(a * b > 0)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, flood_next_24h int").coalesce(1)
    p = [MD.score(MD.fit_mlp(df, ["a", "b"], hidden=(8, 4), max_iter=120, seed=s), df, ["a", "b"]).toPandas()["p"].to_numpy() for s in (5, 5)]
    assert (p[0] == p[1]).all()
    assert (((p[0] >= 0.5).astype(int)) == [r[2] for r in rows]).mean() > 0.95


def test_saved_model_scores_raw_rows_alike(spark, planted, tmp_path):
    _, _, df = planted
    feats = ["a", "b", "c d"]
    raw = df.withColumns({"a": F.when(F.rand(3) > 0.2, F.col("a") * 1e6 + 1 / 3), "c d": F.col("c d") / 7e9})
    raw = spark.createDataFrame(raw.collect(), raw.schema)
    med = FE.train_medians(raw, feats)
    stats = FE.scaling_stats(FE.impute(raw, med), feats)
    ready = FE.standardize(FE.impute(raw, med), stats)
    model = MD.fit_logistic(ready.withColumn("weight", F.lit(1.0)), feats)
    exp = MD.score(model, ready, feats).toPandas()["p"].to_numpy()
    MD.applicable(model, feats, med, stats).write().overwrite().save(str(tmp_path / "m"))
    got = MD.apply_saved(PipelineModel.load(str(tmp_path / "m")), raw)
    assert got.columns == [*raw.columns, "p", "pred"]
    assert np.abs(got.toPandas()["p"].to_numpy() - exp).max() <= 1e-12


def test_threshold_of_other_rows(spark):
    rows = [("m", 0.2, 0), ("m", 0.4, 1), ("m", 0.6, 1), ("n", 0.5, 0), ("n", 0.9, 1)]
    df = spark.createDataFrame(rows, "model string, p double, y int")
    t = spark.createDataFrame([("m", 0.3), ("n", 0.95)], "model string, best_threshold double")
    got = {r["model"]: r for r in EV.metrics_at(df, "y", "p", t, ["model"]).collect()}
    assert (got["m"]["tp"], got["m"]["fp"], got["m"]["fn"], got["m"]["f1"], got["m"]["roc_auc"]) == (2, 0, 0, 1.0, 1.0)
    assert (got["n"]["tp"], got["n"]["fn"], got["n"]["f1"]) == (0, 1, 0.0)


def test_payload_is_complete_and_models_apply(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for e in range(4):
        for d in range(60):
            r = float(rng.gamma(2.0, 5.0))
            rows.append((f"k{e}", f"N{e}", f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}", int(r > 14), r, float(rng.normal()) if d % 5 else None, d % 7))
    panel = spark.createDataFrame(rows, "municipio_key string, municipio_name string, date string, flood_next_24h int, rain double, temp double, dow int").withColumn("date", F.to_date("date"))
    payload, view = PL.train_and_evaluate(spark, panel, str(tmp_path / "out"), dataset_path="somewhere")
    saved = json.loads("\n".join(r[0] for r in spark.read.text(f"{tmp_path}/out/metrics").collect()))
    assert set(saved) >= {"timestamp", "dataset_path", "dataset_shape", "target_positive_rate", "excluded_columns", "usable_feature_columns", "n_features", "split", "models", "artifacts", "imputer", "scaler", "mlp_test_at_best_threshold"}
    assert saved["split"]["train_rows"] + saved["split"]["validation_rows"] + saved["split"]["test_rows"] == 240
    assert saved["mlp_test_at_best_threshold"]["best_threshold"] == saved["mlp_best_validation_threshold"]
    for path, p in ((saved["artifacts"]["baseline_model"], "p_lr"), (saved["artifacts"]["mlp_model"], "p_mlp")):
        raw = MD.apply_saved(PipelineModel.load(path), panel, "again").select("municipio_name", "date", "again")
        both = view.join(raw, ["municipio_name", "date"]).select(p, "again").toPandas()
        assert len(both) and np.abs(both[p] - both["again"]).max() <= 1e-12
