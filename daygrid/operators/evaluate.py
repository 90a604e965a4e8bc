"""Classifier evaluation as aggregates (EVL1-EVL10, NUM3, NUM4, TOP4, TOP5).

Every metric is a grouped aggregate over (model/split/...) groups; ordered
quantities (ROC, AUC) use distributed prefix sums over distinct scores, never
a global window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_small
from .stats import prefix_sums

# Decision threshold grid of the reference sweep (37 points).
SWEEP = [round(0.05 + i * 0.025, 10) for i in range(37)]


def predict(p: Column, threshold: float = 0.5) -> Column:
    """NUM3: class 1 when the probability reaches the threshold."""
    return (p >= F.lit(threshold)).cast("int")


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """EVL1: tn, fp, fn, tp per group (labels fixed to [0, 1])."""
    yy, pp = F.col(y).cast("int"), F.col(pred).cast("int")
    return df.groupBy(*by).agg(
        F.count_if((yy == 0) & (pp == 0)).alias("tn"),
        F.count_if((yy == 0) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp == 0)).alias("fn"),
        F.count_if((yy == 1) & (pp == 1)).alias("tp"),
    )


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    """EVL2: accuracy, precision, recall, F1 (0 when undefined), support."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    support = tn + fp + fn + tp
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    return cm.withColumns(
        {
            "support": support,
            "accuracy": _ratio(tp + tn, support),
            "precision": precision,
            "recall": recall,
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def classification_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """EVL1 + EVL2 + EVL3 for a probability column."""
    pred = df.withColumn("__pred", predict(F.col(p), threshold))
    m = metrics_from_confusion(confusion(pred, y, "__pred", by))
    auc = roc_auc(df, y, p, by)
    return _attach(m, auc, by)


def _attach(m: DataFrame, auc: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return m.join(auc, list(by), "left")
    return m.select("*", auc.select("roc_auc").scalar().alias("roc_auc"))


def _score_counts(df: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    yy = F.col(y).cast("int")
    return df.filter(F.col(p).isNotNull()).groupBy(*by, F.col(p).cast("double").alias("score")).agg(
        F.count_if(yy == 1).alias("pos"), F.count_if(yy == 0).alias("neg")
    )


def roc_auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """EVL3: exact ROC-AUC (ties count one half); null with one class only.

    AUC = sum over distinct scores s of pos(s) * (neg below s + neg(s) / 2) / (P N)."""
    counts = _score_counts(df, y, p, by)
    cum = prefix_sums(counts, ["score"], ["neg"], by=by)
    contrib = F.col("pos") * (F.col("neg_cum") - F.col("neg") + F.col("neg") * 0.5)
    agg = cum.groupBy(*by).agg(F.sum(contrib).alias("__u"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    auc = F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__u") / (F.col("__p") * F.col("__n")))
    return agg.select(*by, auc.alias("roc_auc"))


def roc_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """EVL4: (threshold, fpr, tpr) at every distinct score, descending, plus
    the (0, 0) start (threshold null = infinity). Intermediate collinear points
    are kept."""
    counts = _score_counts(df, y, p, by)
    cum = prefix_sums(counts, ["score"], ["pos", "neg"], ascending=False, by=by)
    tot = counts.groupBy(*by).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    pts = cum.join(tot, list(by), "left") if by else cum.select("*", tot.select("__P").scalar().alias("__P"), tot.select("__N").scalar().alias("__N"))
    curve = pts.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_cum").cast("double"), F.col("__N")).alias("fpr"),
        F.try_divide(F.col("pos_cum").cast("double"), F.col("__P")).alias("tpr"),
    )
    start = tot.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(start)


def class_report(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """EVL5: precision / recall / F1 / support for class 0 and 1, plus macro
    and support-weighted averages."""
    cm = confusion(df, y, pred, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per = []
    for k, (tp_k, fp_k, fn_k) in {"1": (tp, fp, fn), "0": (tn, fn, fp)}.items():
        prec, rec = _ratio(tp_k, tp_k + fp_k), _ratio(tp_k, tp_k + fn_k)
        per.append(
            F.struct(
                F.lit(k).alias("label"),
                prec.alias("precision"),
                rec.alias("recall"),
                _ratio(2 * tp_k, 2 * tp_k + fp_k + fn_k).alias("f1"),
                (tp_k + fn_k).alias("support"),
            )
        )
    rows = cm.select(*by, F.inline(F.array(*per)))
    agg = rows.groupBy(*by).agg(
        F.avg("precision").alias("m_p"),
        F.avg("recall").alias("m_r"),
        F.avg("f1").alias("m_f"),
        F.sum("support").alias("n"),
        F.sum(F.col("precision") * F.col("support")).alias("w_p"),
        F.sum(F.col("recall") * F.col("support")).alias("w_r"),
        F.sum(F.col("f1") * F.col("support")).alias("w_f"),
    )
    avgs = agg.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.lit("macro avg").alias("label"), F.col("m_p").alias("precision"), F.col("m_r").alias("recall"), F.col("m_f").alias("f1"), F.col("n").alias("support")),
                F.struct(
                    F.lit("weighted avg").alias("label"),
                    _ratio(F.col("w_p"), F.col("n")).alias("precision"),
                    _ratio(F.col("w_r"), F.col("n")).alias("recall"),
                    _ratio(F.col("w_f"), F.col("n")).alias("f1"),
                    F.col("n").alias("support"),
                ),
            )
        ),
    )
    return rows.unionByName(avgs)


def threshold_sweep(df: DataFrame, y: str, p: str, by: Sequence[str] = (), thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """EVL6: precision, recall, F1 at each threshold. Every score is put between
    two thresholds once and counted there; the few counts are then cumulated."""
    grid = sorted(float(t) for t in thresholds)
    label = F.col(y).cast("int")
    reached = F.when(F.col(p).isNotNull(), F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: t <= F.col(p))))
    counts = df.groupBy(*by, reached.alias("__k")).agg(F.count_if(label == 1).alias("__pos"), F.count_if(label == 0).alias("__neg")).filter("__k IS NOT NULL")
    each = counts.select("*", F.posexplode(F.array(*map(F.lit, grid))).alias("__i", "threshold"))
    total = lambda c, hit: F.sum(F.when((F.col("__k") > F.col("__i")) == F.lit(hit), F.col(c)).otherwise(0))
    cm = each.groupBy(*by, "threshold").agg(total("__neg", False).alias("tn"), total("__neg", True).alias("fp"), total("__pos", False).alias("fn"), total("__pos", True).alias("tp"))
    return metrics_from_confusion(cm).select(*by, "threshold", "precision", "recall", "f1")


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """TOP5: first threshold with the maximal F1 (smallest among ties)."""
    return sweep.groupBy(*by).agg(
        F.min_by(F.col("threshold"), F.struct(-F.col("f1"), F.col("threshold"))).alias("best_threshold"),
        F.max("f1").alias("best_f1"),
    )


def metrics_at(df: DataFrame, y: str, p: str, thresholds: DataFrame, by: Sequence[str]) -> DataFrame:
    """EVL6: metrics of ``df`` with the class taken at each group's own ``best_threshold``
    (``thresholds``: one row a group), chosen on other rows."""
    dealt = join_small(df, thresholds.select(*by, "best_threshold"), list(by))
    pred = dealt.withColumn("__pred", (F.col(p) >= F.col("best_threshold")).cast("int"))
    m = metrics_from_confusion(confusion(pred, y, "__pred", [*by, "best_threshold"]))
    return m.join(roc_auc(df, y, p, by), list(by), "left")


def best_row(df: DataFrame, metric: str = "f1", order: Sequence[str] = ()) -> DataFrame:
    """TOP5: the single row with the highest metric (ties by ``order``)."""
    return df.orderBy(F.desc(metric), *[F.asc(o) for o in order]).limit(1)


def daily_rates(view: DataFrame, day: str = "day", y: str = "y_true", preds: Sequence[str] = ("pred_lr", "pred_mlp"), prob: str = "p_mlp") -> DataFrame:
    """EVL9: per day actual rate, predicted rates and mean probability."""
    return view.groupBy(F.to_date(day).alias("day")).agg(
        F.avg(F.col(y).cast("double")).alias("real_rate"),
        *[F.avg(F.col(c).cast("double")).alias(f"pred_rate_{c.split('_', 1)[-1]}") for c in preds],
        F.avg(prob).alias(f"mean_prob_{prob.split('_', 1)[-1]}"),
    )


def top_risk(view: DataFrame, entity: str, prob: str, n: int = 15) -> DataFrame:
    """TOP4: entities with the highest mean predicted probability."""
    return view.groupBy(entity).agg(F.avg(prob).alias(prob)).orderBy(F.desc(prob), F.asc(entity)).limit(n)


# Wording and cut-offs of the reference's automatic reading.
IMBALANCE = ((0.10, "alto"), (0.30, "moderado"))
IMBALANCE_ELSE = "bajo"
FIT_GAP = 0.10
FIT_LOW = 0.35
FIT_OVER = "Posible sobreajuste (brecha train-val alta en F1)."
FIT_UNDER = "Posible subajuste (desempeño bajo tanto en train como en validation)."
FIT_OK = "Generalización razonable para baseline inicial."
PR_MARGIN = 0.08
PR_RECALL = "Recall más problemático que precision (se escapan eventos positivos)."
PR_PRECISION = "Precision más problemática que recall (más falsos positivos)."
PR_OK = "Balance precision-recall aceptable para baseline."


def imbalance_label(rate: Column) -> Column:
    """NUM4: imbalance bucket of a positive rate."""
    (c1, l1), (c2, l2) = IMBALANCE
    return F.when(rate < c1, F.lit(l1)).when(rate < c2, F.lit(l2)).otherwise(F.lit(IMBALANCE_ELSE))


def fit_diagnosis(train_f1: Column, val_f1: Column) -> Column:
    """NUM4: over/under-fitting reading from train and validation F1."""
    return (
        F.when(train_f1 - val_f1 > FIT_GAP, F.lit(FIT_OVER))
        .when((val_f1 < FIT_LOW) & (train_f1 < FIT_LOW), F.lit(FIT_UNDER))
        .otherwise(F.lit(FIT_OK))
    )


def precision_recall_comment(precision: Column, recall: Column) -> Column:
    """NUM4: which of precision / recall is the weaker one."""
    return (
        F.when(recall + PR_MARGIN < precision, F.lit(PR_RECALL))
        .when(precision + PR_MARGIN < recall, F.lit(PR_PRECISION))
        .otherwise(F.lit(PR_OK))
    )
