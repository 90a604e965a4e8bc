"""Baseline classifiers on Spark ML (MOD1-MOD3).

Training iterates over the prepared training rows, so they are cut from the
build lineage first (checkpoint in the shared folder): an executor lost in
iteration k recomputes one partition of that file, not the whole panel.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TARGET
from ..session import cut_lineage


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str = TARGET, weight_col: str | None = "weight", C: float = 1.0, max_iter: int = 1000
):
    """MOD1: L2 logistic regression (L-BFGS). The penalty ``1/2 ||b||^2`` next
    to ``C * sum(w_i loss_i)`` equals Spark's ``regParam = 1 / (C * sum(w))``
    on the mean weighted loss; features are standardized beforehand."""
    data = cut_lineage(assemble(train, features).select("features", F.col(label).cast("double").alias("label"), *([weight_col] if weight_col else [])))
    total_w = data.agg(F.sum(F.col(weight_col)) if weight_col else F.count(F.lit(1))).collect()[0][0]
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        regParam=1.0 / (C * float(total_w)),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        family="binomial",
    )
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr.fit(data)


def fit_mlp(
    train: DataFrame, features: Sequence[str], label: str = TARGET, hidden: Sequence[int] = (64, 32), max_iter: int = 200, seed: int = 42
):
    """MOD2: feed-forward network d-64-32-2 (Spark's sigmoid hidden layers,
    softmax output, L-BFGS)."""
    data = cut_lineage(assemble(train, features).select("features", F.col(label).cast("double").alias("label")))
    # every L-BFGS iteration is a pass over the rows: keep them in memory
    # (spilling to disk); the checkpoint underneath survives executor loss
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    mlp = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[len(features), *hidden, 2], maxIter=max_iter, seed=seed, solver="l-bfgs"
    )
    try:
        return mlp.fit(data)
    finally:
        data.unpersist()


def score(model, df: DataFrame, features: Sequence[str], prob_col: str = "p", pred_col: str = "pred", threshold: float = 0.5) -> DataFrame:
    """MOD3: probability of class 1 and the class at ``threshold``."""
    scored = model.transform(assemble(df, features))
    p = vector_to_array(F.col("probability"))[1]
    out = scored.withColumn(prob_col, p).withColumn(pred_col, (F.col(prob_col) >= threshold).cast("int"))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def prepared(medians: Mapping[str, float], stats: Mapping[str, tuple[float, float]], suffix: str = "__z") -> SQLTransformer:
    """Train-fitted imputation and scaling as one Spark ML stage: adds ``<c><suffix>``,
    (value or train median - mean) / std, for every feature. The fitted numbers are part of
    the stage, to the last bit, and are saved and loaded with it."""
    exact = lambda x: f"CAST('{float(x)!r}' AS DOUBLE)"
    columns = []
    for c, (mean, std) in stats.items():
        name = c.replace("`", "``")
        columns.append(f"(coalesce(CAST(`{name}` AS DOUBLE), {exact(medians[c])}) - {exact(mean)}) / {exact(std)} AS `{name}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def applicable(model, features: Sequence[str], medians: Mapping[str, float], stats: Mapping[str, tuple[float, float]]) -> PipelineModel:
    """MOD3/SRC16: imputer, scaler and classifier as one ``PipelineModel`` that scores raw panel
    rows wherever it is loaded (``PipelineModel.load``)."""
    scaled = prepared(medians, {c: stats[c] for c in features})
    vector = VectorAssembler(inputCols=[f"{c}__z" for c in features], outputCol="features", handleInvalid="keep")
    return PipelineModel(stages=[scaled, vector, model])


def apply_saved(pipeline: PipelineModel, df: DataFrame, prob_col: str = "p", pred_col: str = "pred", threshold: float = 0.5) -> DataFrame:
    """``df`` with the probability of class 1 and the class at ``threshold``."""
    p = vector_to_array(F.col("probability"))[1]
    out = pipeline.transform(df).withColumn(prob_col, p)
    return out.select(*df.columns, prob_col, (F.col(prob_col) >= threshold).cast("int").alias(pred_col))
