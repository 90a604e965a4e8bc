"""Registered split, feature-preparation, model and evaluation queries.

Metric operators are checked on two scored tables derived from the driver
data: labelled documents (quality label, two deterministic scores) and the
panel split in time (next-day label, two deterministic scores from the
features). The trained models run on the imputed panel (rows-only checks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import filters as FL
from ..operators import models as MD
from ..operators import profile as P
from ..operators.impute import impute_three_level
from ..operators.split import split_report as _split_report
from ..operators.split import temporal_split as _temporal_split
from ..schema import DATE, KEY, NAME, NON_FEATURES, TARGET
from . import analogues as S
from .panel_ops_queries import CTE_PANEL, LEVEL_COLS, RAIN_NAMES, WEATHER_COLS, full_panel
from .profile_queries import _sql_hist
from ..session import cut_lineage
from .registry import query

MODELS = ("p_lr", "p_mlp")

# ---------------------------------------------------------------------------
# Scored tables
# ---------------------------------------------------------------------------


def scored_docs(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with two deterministic scores in [0, 1)."""
    lab = S.table(spark, d, "labels")
    docs = S.table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    j = lab.join(docs, "doc_id")
    return j.select(
        "doc_id",
        "lang",
        F.col("quality").cast("int").alias("y_true"),
        (F.pmod(F.col("n_chars"), F.lit(1000)) / 1000.0).alias("p_lr"),
        (F.pmod(F.col("doc_id") * 37, F.lit(101)) / 100.0).alias("p_mlp"),
    )


def _long_models(df: DataFrame, keep) -> DataFrame:
    return df.select(
        *keep,
        "y_true",
        F.inline(F.array(*[F.struct(F.lit(m.split("_", 1)[1]).alias("model"), F.col(m).alias("p")) for m in MODELS])),
    )


SQL_DOCS = """
docs_scored AS (
  SELECT l.doc_id, d.lang, CAST(l.quality AS INTEGER) AS y_true,
         CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS p_lr, CAST((d.doc_id * 37) % 101 AS DOUBLE) / 100.0 AS p_mlp
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
dl AS (
  SELECT doc_id, lang, y_true, 'lr' AS model, p_lr AS p FROM docs_scored
  UNION ALL SELECT doc_id, lang, y_true, 'mlp' AS model, p_mlp AS p FROM docs_scored
)"""


def panel_split(spark: SparkSession, d: str) -> DataFrame:
    """The built panel, written once to the checkpoint folder, split in time
    (the split reads the panel twice: for its day bounds and for the rows)."""
    return _temporal_split(cut_lineage(full_panel(spark, d)))


def scored_panel(spark: SparkSession, d: str) -> DataFrame:
    """Panel rows with their split, label and two deterministic scores."""
    sp = panel_split(spark, d)
    rain = F.coalesce(F.col("precip_mm_72h_sum"), F.lit(0.0))
    return sp.select(
        KEY,
        NAME,
        DATE,
        "split",
        F.col(TARGET).alias("y_true"),
        (rain / (rain + 100.0)).alias("p_lr"),
        F.least(F.coalesce(F.col("meteo_rh_max_24h"), F.lit(0.0)) * 10.0, F.lit(1.0)).alias("p_mlp"),
    )


CTE_SPLIT = f"""{CTE_PANEL},
days AS (SELECT DISTINCT date AS day FROM panel WHERE date IS NOT NULL),
rk AS (SELECT day, row_number() OVER (ORDER BY day) AS rn FROM days),
nd AS (SELECT count(*) AS n FROM days),
cut AS (SELECT n, greatest(floor(n * 0.7), 1) AS te FROM nd),
cut2 AS (SELECT n, te, least(greatest(te + 1, floor(n * 0.85)), n - 1) AS ve FROM cut),
bnd AS (SELECT (SELECT day FROM rk WHERE rn = te + 1) AS b1, (SELECT day FROM rk WHERE rn = ve + 1) AS b2 FROM cut2),
sp AS (
  SELECT p.*, CASE WHEN p.date < b.b1 THEN 'train' WHEN p.date < b.b2 THEN 'validation' ELSE 'test' END AS split
  FROM panel p CROSS JOIN bnd b
),
ps AS (
  SELECT municipio_key, municipio_name, date, split, flood_next_24h AS y_true,
         coalesce(precip_mm_72h_sum, 0.0) / (coalesce(precip_mm_72h_sum, 0.0) + 100.0) AS p_lr,
         least(coalesce(meteo_rh_max_24h, 0.0) * 10.0, 1.0) AS p_mlp
  FROM sp
),
pl AS (
  SELECT municipio_key, municipio_name, date, split, y_true, 'lr' AS model, p_lr AS p FROM ps
  UNION ALL SELECT municipio_key, municipio_name, date, split, y_true, 'mlp' AS model, p_mlp AS p FROM ps
)"""


def sql_metrics(src: str, by: str, threshold: float = 0.5) -> str:
    """CTE ``met`` with confusion, metrics and exact AUC per ``by`` group."""
    return f"""
cm AS (
  SELECT {by}, count(*) FILTER (WHERE y_true = 0 AND p < {threshold}) AS tn, count(*) FILTER (WHERE y_true = 0 AND p >= {threshold}) AS fp,
         count(*) FILTER (WHERE y_true = 1 AND p < {threshold}) AS fn, count(*) FILTER (WHERE y_true = 1 AND p >= {threshold}) AS tp
  FROM {src} GROUP BY {by}
),
sc AS (SELECT {by}, p AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg FROM {src} WHERE p IS NOT NULL GROUP BY {by}, p),
scc AS (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM sc),
au AS (
  SELECT {by}, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(CAST(pos AS DOUBLE) * (neg_cum - neg + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc
  FROM scc GROUP BY {by}
),
met AS (
  SELECT cm.*, tn + fp + fn + tp AS support,
    CASE WHEN tn + fp + fn + tp = 0 THEN 0.0 ELSE (tp + tn) / (tn + fp + fn + tp) END AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
    au.roc_auc
  FROM cm JOIN au USING ({by})
)"""


def _r(cols) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


# ---------------------------------------------------------------------------
# Evaluation on labelled documents
# ---------------------------------------------------------------------------


@query(
    "confusion_metrics",
    f"""
WITH {SQL_DOCS}, {sql_metrics('dl', 'model, lang')}
SELECT model, lang, tn, fp, fn, tp, support, {_r(['accuracy', 'precision', 'recall', 'f1', 'roc_auc'])} FROM met
""",
)
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    """EVL1-EVL3 + NUM3: confusion matrix, metrics and AUC per (model, language)."""
    long = _long_models(scored_docs(spark, d), ["doc_id", "lang"])
    return EV.classification_metrics(long, "y_true", "p", ["model", "lang"])


@query(
    "roc_auc_exact",
    f"""
WITH {SQL_DOCS}, {sql_metrics('dl', 'model')}
SELECT model, {_r(['roc_auc'])} FROM met
""",
)
def roc_auc_exact(spark: SparkSession, d: str) -> DataFrame:
    """EVL3: exact rank-sum AUC per model (ties at one half)."""
    long = _long_models(scored_docs(spark, d), ["doc_id"])
    return EV.roc_auc(long, "y_true", "p", ["model"])


@query(
    "roc_curve",
    f"""
WITH {SQL_DOCS},
sc AS (SELECT model, p AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg FROM dl GROUP BY model, p),
tot AS (SELECT model, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY model),
cu AS (
  SELECT model, score,
    sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
  FROM sc
)
SELECT cu.model, round(score, 6) + 0.0 AS threshold, round(fp / tot.N, 6) + 0.0 AS fpr, round(tp / tot.P, 6) + 0.0 AS tpr
FROM cu JOIN tot ON cu.model = tot.model
UNION ALL SELECT model, NULL, 0.0, 0.0 FROM tot
""",
)
def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    """EVL4: ROC points per model at every distinct score."""
    long = _long_models(scored_docs(spark, d), ["doc_id"])
    return EV.roc_curve(long, "y_true", "p", ["model"])


@query(
    "class_report",
    f"""
WITH {SQL_DOCS}, {sql_metrics('dl', 'model')},
per AS (
  SELECT model, '1' AS label, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS support FROM cm
  UNION ALL
  SELECT model, '0', CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END,
         CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END, tn + fp FROM cm
),
av AS (
  SELECT model, 'macro avg' AS label, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, CAST(sum(support) AS BIGINT) AS support FROM per GROUP BY model
  UNION ALL
  SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT)
  FROM per GROUP BY model
)
SELECT model, label, {_r(['precision', 'recall', 'f1'])}, support FROM (SELECT * FROM per UNION ALL SELECT * FROM av)
""",
)
def class_report(spark: SparkSession, d: str) -> DataFrame:
    """EVL5: per-class precision/recall/F1/support with macro and weighted averages."""
    long = _long_models(scored_docs(spark, d), ["doc_id"]).withColumn("pred", EV.predict(F.col("p")))
    return EV.class_report(long, "y_true", "pred", ["model"])


def _sql_sweep(src: str, by: str) -> str:
    ts = ", ".join(f"({t})" for t in EV.SWEEP)
    return f"""
th AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES {ts}) t(threshold)),
sw0 AS (
  SELECT {by}, th.threshold,
    count(*) FILTER (WHERE y_true = 1 AND p >= th.threshold) AS tp,
    count(*) FILTER (WHERE y_true = 0 AND p >= th.threshold) AS fp,
    count(*) FILTER (WHERE y_true = 1 AND p < th.threshold) AS fn
  FROM {src} CROSS JOIN th GROUP BY {by}, th.threshold
),
sw AS (
  SELECT {by}, CAST(threshold AS DOUBLE) AS threshold,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1
  FROM sw0
)"""


@query(
    "threshold_sweep",
    f"""
WITH {SQL_DOCS}, {_sql_sweep('dl', 'model')}
SELECT model, round(threshold, 6) AS threshold, {_r(['precision', 'recall', 'f1'])} FROM sw
""",
)
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    """EVL6: precision, recall and F1 at the 37 thresholds 0.05..0.95."""
    long = _long_models(scored_docs(spark, d), ["doc_id"])
    return EV.threshold_sweep(long, "y_true", "p", ["model"])


@query(
    "best_threshold",
    f"""
WITH {SQL_DOCS}, {_sql_sweep('dl', 'model')}
SELECT model, round((array_agg(threshold ORDER BY f1 DESC, threshold))[1], 6) AS best_threshold, round(max(f1), 6) + 0.0 AS best_f1 FROM sw GROUP BY model
""",
)
def best_threshold(spark: SparkSession, d: str) -> DataFrame:
    """TOP5: first threshold reaching the best F1, per model."""
    long = _long_models(scored_docs(spark, d), ["doc_id"])
    return EV.best_threshold(EV.threshold_sweep(long, "y_true", "p", ["model"]), ["model"])


@query(
    "score_histogram_by_class",
    f"""
WITH {SQL_DOCS}, {_sql_hist(['p_mlp'], 30, 'docs_scored', by='y_true')}
SELECT * FROM hist
""",
)
def score_histogram_by_class(spark: SparkSession, d: str) -> DataFrame:
    """EVL10: 30-bin histogram of a score for each true class over its own range."""
    return P.histogram(scored_docs(spark, d), ["p_mlp"], 30, by="y_true")


@query(
    "class_rows",
    f"""
WITH {SQL_DOCS}
SELECT doc_id, round(p_mlp, 6) AS p_mlp FROM docs_scored WHERE y_true = 1
""",
)
def class_rows(spark: SparkSession, d: str) -> DataFrame:
    """FLT10: the scores of the positive class."""
    return FL.class_rows(scored_docs(spark, d), "y_true", 1).select("doc_id", "p_mlp")


# ---------------------------------------------------------------------------
# Split, features and evaluation on the panel
# ---------------------------------------------------------------------------


@query(
    "temporal_split",
    f"""
WITH {CTE_SPLIT}
SELECT municipio_key, date, split FROM sp
""",
)
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    """SPL1 + WIN7: 70/15/15 % of distinct days in time order."""
    return panel_split(spark, d).select(KEY, DATE, "split")


@query(
    "split_report",
    f"""
WITH {CTE_SPLIT}
SELECT split, min(date) AS date_min, max(date) AS date_max, count(DISTINCT date) AS n_days, count(*) AS rows,
       round(avg(CAST(coalesce(flood_next_24h, 0) AS DOUBLE)), 6) AS positive_rate
FROM sp GROUP BY split
""",
)
def split_report(spark: SparkSession, d: str) -> DataFrame:
    """SPL2: day range, days, rows and positive rate of each split."""
    return _split_report(panel_split(spark, d))


FEATURES = ["stations_in_municipio", "latitud_raw", *WEATHER_COLS, *RAIN_NAMES, *LEVEL_COLS, "year", "month", "day", "day_of_year", "day_of_week", "is_weekend"]


@query(
    "usable_features",
    f"""
WITH {CTE_PANEL}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS non_null, (count({c}) > 0 AND min({c}) <> max({c})) AS usable FROM panel" for c in FEATURES)}
""",
)
def usable_features(spark: SparkSession, d: str) -> DataFrame:
    """FEA1: numeric features with a value and more than one distinct value."""
    p = full_panel(spark, d)
    return FE.feature_usability(p, FE.candidate_features(p, NON_FEATURES))


FILLABLE = ["stations_in_municipio", "latitud_raw", *WEATHER_COLS, *RAIN_NAMES, *LEVEL_COLS]


@query(
    "median_impute_train",
    f"""
WITH {CTE_SPLIT}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, round(median({c}) FILTER (WHERE split = 'train'), 6) + 0.0 AS median FROM sp" for c in FILLABLE)}
""",
)
def median_impute_train(spark: SparkSession, d: str) -> DataFrame:
    """FEA2: exact medians fitted on the training days only."""
    sp = panel_split(spark, d)
    med = FE.train_medians(sp.filter(F.col("split") == "train"), FILLABLE)
    return spark.createDataFrame([(c, med[c]) for c in FILLABLE], "feature string, median double")


@query(
    "standardize_train",
    f"""
WITH {CTE_SPLIT},
med AS (SELECT {', '.join(f"median({c}) FILTER (WHERE split = 'train') AS m_{c}" for c in FILLABLE)} FROM sp),
imp AS (SELECT sp.split, {', '.join(f'coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}' for c in FILLABLE)} FROM sp CROSS JOIN med)
{' UNION ALL '.join(
    f"SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE split = 'train'), 6) + 0.0 AS mean, "
    f"round(CASE WHEN stddev_pop({c}) FILTER (WHERE split = 'train') = 0 THEN 1.0 ELSE stddev_pop({c}) FILTER (WHERE split = 'train') END, 6) AS std FROM imp"
    for c in FILLABLE)}
""",
)
def standardize_train(spark: SparkSession, d: str) -> DataFrame:
    """FEA2 + FEA3: train-median imputation, then train mean and population std."""
    sp = panel_split(spark, d)
    train = sp.filter(F.col("split") == "train")
    med = FE.train_medians(train, FILLABLE)
    stats = FE.scaling_stats(FE.impute(train, med), FILLABLE)
    return spark.createDataFrame([(c, stats[c][0], stats[c][1]) for c in FILLABLE], "feature string, mean double, std double")


@query(
    "class_weights",
    f"""
WITH {CTE_SPLIT},
c AS (SELECT CAST(flood_next_24h AS INTEGER) AS class, count(*) AS rows FROM sp WHERE split = 'train' GROUP BY 1),
t AS (SELECT sum(rows) AS n, count(*) AS k, sum(rows) FILTER (WHERE class = 1) * 1.0 / sum(rows) AS rate FROM c)
SELECT class, rows, round(CASE WHEN t.rate < 0.4 AND t.k > 1 THEN t.n / (t.k * rows) ELSE 1.0 END, 6) AS weight FROM c CROSS JOIN t
""",
)
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    """CLS1: balanced class weights on the training split."""
    train = panel_split(spark, d).filter(F.col("split") == "train")
    counts = FE.class_counts(train)
    weights, _ = FE.balanced_weights(train, counts=counts)
    return spark.createDataFrame([(k, counts[k], weights[k]) for k in counts], "class int, rows bigint, weight double")


@query(
    "oversample_sizes",
    f"""
WITH {CTE_SPLIT},
c AS (SELECT CAST(flood_next_24h AS INTEGER) AS class, count(*) AS rows FROM sp WHERE split = 'train' GROUP BY 1)
SELECT class, rows AS rows_before, (SELECT max(rows) FROM c) AS rows_after FROM c
""",
)
def oversample_sizes(spark: SparkSession, d: str) -> DataFrame:
    """CLS2: class sizes before and after exact random oversampling (the
    oversampled rows are drawn and counted)."""
    train = panel_split(spark, d).filter(F.col("split") == "train")
    before = train.groupBy(F.col(TARGET).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("rows_before"))
    over, _ = FE.oversample_minority(train)
    after = over.groupBy(F.col(TARGET).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("rows_after"))
    return before.join(after, "class")


@query(
    "model_comparison",
    f"""
WITH {CTE_SPLIT}, {sql_metrics('pl', 'model, split')}
SELECT model, split, {_r(['accuracy', 'precision', 'recall', 'f1', 'roc_auc'])} FROM met
""",
)
def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """EVL7: accuracy, precision, recall, F1 and AUC per (model, split)."""
    long = _long_models(scored_panel(spark, d), [KEY, DATE, "split"])
    m = EV.classification_metrics(long, "y_true", "p", ["model", "split"])
    return m.select("model", "split", "accuracy", "precision", "recall", "f1", "roc_auc")


@query(
    "test_at_best_threshold",
    f"""
WITH {CTE_SPLIT}, pv AS (SELECT * FROM pl WHERE split = 'validation'), {_sql_sweep('pv', 'model')},
bt AS (SELECT model, (array_agg(threshold ORDER BY f1 DESC, threshold))[1] AS t FROM sw GROUP BY model),
pt AS (SELECT model, t, y_true, CASE WHEN p >= t THEN 1 ELSE 0 END AS h FROM pl JOIN bt USING (model) WHERE split = 'test'),
cm AS (SELECT model, t, count(*) FILTER (WHERE y_true = 1 AND h = 1) AS tp, count(*) FILTER (WHERE y_true = 0 AND h = 1) AS fp,
              count(*) FILTER (WHERE y_true = 1 AND h = 0) AS fn FROM pt GROUP BY model, t)
SELECT model, round(t, 6) AS best_threshold, tp, fp, fn,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) + 0.0 AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) + 0.0 AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) + 0.0 AS f1
FROM cm
""",
)
def test_at_best_threshold(spark: SparkSession, d: str) -> DataFrame:
    """EVL6: the threshold with the best validation F1, applied to the test rows, per model."""
    long = cut_lineage(_long_models(scored_panel(spark, d).filter("split <> 'train'"), ["split"]))
    sweep = EV.threshold_sweep(long.filter("split = 'validation'"), "y_true", "p", ["model"])
    m = EV.metrics_at(long.filter("split = 'test'"), "y_true", "p", EV.best_threshold(sweep, ["model"]), ["model"])
    return m.select("model", F.round("best_threshold", 6).alias("best_threshold"), "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "best_model",
    f"""
WITH {CTE_SPLIT}, {sql_metrics('pl', 'model, split')}
SELECT model, split, round(f1, 6) + 0.0 AS f1 FROM met WHERE split = 'validation' ORDER BY f1 DESC, model LIMIT 1
""",
)
def best_model(spark: SparkSession, d: str) -> DataFrame:
    """TOP5: the model with the best validation F1."""
    long = _long_models(scored_panel(spark, d), [KEY, DATE, "split"])
    m = EV.classification_metrics(long.filter(F.col("split") == "validation"), "y_true", "p", ["model", "split"])
    return EV.best_row(m.select("model", "split", "f1"), "f1", ["model"])


@query(
    "metric_buckets",
    f"""
WITH {CTE_SPLIT}, {sql_metrics('pl', 'model, split')},
rate AS (SELECT avg(CAST(y_true AS DOUBLE)) AS r FROM ps),
w AS (
  SELECT t.model, t.f1 AS train_f1, v.f1 AS val_f1, v.precision AS val_precision, v.recall AS val_recall
  FROM met t JOIN met v ON t.model = v.model AND t.split = 'train' AND v.split = 'validation'
)
SELECT model,
  CASE WHEN r < {EV.IMBALANCE[0][0]} THEN '{EV.IMBALANCE[0][1]}' WHEN r < {EV.IMBALANCE[1][0]} THEN '{EV.IMBALANCE[1][1]}' ELSE '{EV.IMBALANCE_ELSE}' END AS imbalance,
  CASE WHEN train_f1 - val_f1 > {EV.FIT_GAP} THEN '{EV.FIT_OVER}' WHEN val_f1 < {EV.FIT_LOW} AND train_f1 < {EV.FIT_LOW} THEN '{EV.FIT_UNDER}' ELSE '{EV.FIT_OK}' END AS fit_diagnosis,
  CASE WHEN val_recall + {EV.PR_MARGIN} < val_precision THEN '{EV.PR_RECALL}' WHEN val_precision + {EV.PR_MARGIN} < val_recall THEN '{EV.PR_PRECISION}' ELSE '{EV.PR_OK}' END AS pr_comment
FROM w CROSS JOIN rate
""",
)
def metric_buckets(spark: SparkSession, d: str) -> DataFrame:
    """NUM4: imbalance level, fit diagnosis and precision/recall reading per model."""
    sp = scored_panel(spark, d)
    long = _long_models(sp, [KEY, DATE, "split"])
    m = EV.classification_metrics(long, "y_true", "p", ["model", "split"])
    t = m.filter(F.col("split") == "train").select("model", F.col("f1").alias("train_f1"))
    v = m.filter(F.col("split") == "validation").select("model", F.col("f1").alias("val_f1"), F.col("precision").alias("vp"), F.col("recall").alias("vr"))
    rate = sp.agg(F.avg(F.col("y_true").cast("double")).alias("r")).select("r").scalar()
    return t.join(v, "model").select(
        "model",
        EV.imbalance_label(rate).alias("imbalance"),
        EV.fit_diagnosis(F.col("train_f1"), F.col("val_f1")).alias("fit_diagnosis"),
        EV.precision_recall_comment(F.col("vp"), F.col("vr")).alias("pr_comment"),
    )


def prediction_view(spark: SparkSession, d: str) -> DataFrame:
    sp = scored_panel(spark, d).filter(F.col("split") == "test")
    return sp.select(
        DATE,
        NAME,
        "y_true",
        "p_lr",
        "p_mlp",
        EV.predict(F.col("p_lr")).alias("pred_lr"),
        EV.predict(F.col("p_mlp")).alias("pred_mlp"),
        F.to_date(DATE).alias("day"),
    )


SQL_VIEW = """
view AS (
  SELECT date, municipio_name, y_true, p_lr, p_mlp, CAST(p_lr >= 0.5 AS INTEGER) AS pred_lr,
         CAST(p_mlp >= 0.5 AS INTEGER) AS pred_mlp, date AS day
  FROM ps WHERE split = 'test'
)"""


@query(
    "prediction_view",
    f"""
WITH {CTE_SPLIT}, {SQL_VIEW}
SELECT date, municipio_name, y_true, {_r(['p_lr', 'p_mlp'])}, pred_lr, pred_mlp, day FROM view
""",
)
def prediction_view_q(spark: SparkSession, d: str) -> DataFrame:
    """EVL8: test-period view with truth, both probabilities and both classes."""
    return prediction_view(spark, d)


@query(
    "daily_rates",
    f"""
WITH {CTE_SPLIT}, {SQL_VIEW}
SELECT day, round(avg(CAST(y_true AS DOUBLE)), 6) AS real_rate, round(avg(CAST(pred_lr AS DOUBLE)), 6) AS pred_rate_lr,
       round(avg(CAST(pred_mlp AS DOUBLE)), 6) AS pred_rate_mlp, round(avg(p_mlp), 6) AS mean_prob_mlp
FROM view GROUP BY day
""",
)
def daily_rates(spark: SparkSession, d: str) -> DataFrame:
    """EVL9: per test day the actual rate, predicted rates and mean probability."""
    return EV.daily_rates(prediction_view(spark, d))


@query(
    "top15_risk",
    f"""
WITH {CTE_SPLIT}, {SQL_VIEW}
SELECT municipio_name, round(avg(p_mlp), 6) + 0.0 AS p_mlp FROM view GROUP BY municipio_name ORDER BY avg(p_mlp) DESC, municipio_name LIMIT 15
""",
)
def top15_risk(spark: SparkSession, d: str) -> DataFrame:
    """TOP4: the 15 entities with the highest mean test probability."""
    return EV.top_risk(prediction_view(spark, d), NAME, "p_mlp", 15)


@query(
    "date_set_filter",
    f"""
WITH {CTE_SPLIT}
SELECT municipio_key, date FROM panel WHERE date IN (SELECT date FROM sp WHERE split = 'validation')
""",
)
def date_set_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT9: panel rows whose day belongs to the validation day set (left-semi join)."""
    p = cut_lineage(full_panel(spark, d))  # built once, for the day set and for the rows
    val_days = _temporal_split(p).filter(F.col("split") == "validation").select(F.col(DATE).alias("date")).distinct()
    return FL.in_date_set(p.select(KEY, DATE), DATE, val_days, "date")


# ---------------------------------------------------------------------------
# Trained models (rows-only)
# ---------------------------------------------------------------------------


def prepared(spark: SparkSession, d: str):
    """Imputed panel -> usable features -> split -> train-fitted imputation
    and scaling (the reference's training preparation)."""
    panel = cut_lineage(impute_three_level(full_panel(spark, d)))
    feats = FE.usable_features(panel)
    sp = cut_lineage(_temporal_split(panel))  # read by every fitting pass
    train = sp.filter(F.col("split") == "train")
    med = FE.train_medians(train, feats)
    feats = [c for c in feats if med.get(c) is not None]
    stats = FE.scaling_stats(FE.impute(train, med), feats)
    ready = FE.standardize(FE.impute(sp, med), stats)
    return ready, feats


@query("logistic_scores")
def logistic_scores(spark: SparkSession, d: str) -> DataFrame:
    """MOD1 + CLS1 + MOD3: balanced L2 logistic regression, scored on every split."""
    ready, feats = prepared(spark, d)
    train = ready.filter(F.col("split") == "train")
    weights, _ = FE.balanced_weights(train)
    model = MD.fit_logistic(FE.with_weights(train, weights), feats)
    return MD.score(model, ready, feats, "p_lr", "pred_lr").select(KEY, DATE, "split", F.col(TARGET).alias("y_true"), "p_lr", "pred_lr")


@query("mlp_scores")
def mlp_scores(spark: SparkSession, d: str) -> DataFrame:
    """CLS2 + MOD2 + MOD3: 64-32 network on the oversampled training split."""
    ready, feats = prepared(spark, d)
    train = ready.filter(F.col("split") == "train")
    over, _ = FE.oversample_minority(train.select(*feats, TARGET))
    model = MD.fit_mlp(over, feats)
    return MD.score(model, ready, feats, "p_mlp", "pred_mlp").select(KEY, DATE, "split", F.col(TARGET).alias("y_true"), "p_mlp", "pred_mlp")
