"""Feature preparation fitted on the training split (FEA1-FEA3, CLS1, CLS2)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..schema import NON_FEATURES, TARGET
from .joins import join_bounded
from .stats import exact_medians


def candidate_features(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def feature_usability(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FEA1: (feature, non_null, usable): usable when at least one value is
    present and there is more than one distinct value (min != max)."""
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}__n").alias("non_null"),
            ((F.col(f"{c}__n") > 0) & (F.col(f"{c}__lo") != F.col(f"{c}__hi"))).alias("usable"),
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


def usable_features(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """FEA1 as a list (one aggregate job), in column order."""
    cols = candidate_features(df, exclude)
    flags = {r["feature"]: r["usable"] for r in feature_usability(df, cols).collect()}
    return [c for c in cols if flags.get(c)]


def train_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """FEA2 fit: exact interpolated medians of the training rows."""
    return exact_medians(train, cols)


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """FEA2 apply: nulls -> train median; a column with no train median
    (all null in train) is dropped, as the fitted imputer would."""
    keep = {c: m for c, m in medians.items() if m is not None}
    dropped = [c for c, m in medians.items() if m is None]
    out = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in keep.items()})
    return out.drop(*dropped)


def scaling_stats(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """FEA3 fit: train mean and population std (std 0 -> scale 1)."""
    row = train.agg(*[F.avg(c).alias(f"{c}__m") for c in cols], *[F.stddev_pop(c).alias(f"{c}__s") for c in cols]).collect()[0]
    out = {}
    for c in cols:
        m, s = row[f"{c}__m"], row[f"{c}__s"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def standardize(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """FEA3 apply: (x - mean) / std with the train statistics."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def class_counts(train: DataFrame, label: str = TARGET) -> dict[int, int]:
    return {int(r[0]): r[1] for r in train.groupBy(F.col(label).cast("int")).count().collect()}


def balanced_weights(
    train: DataFrame, label: str = TARGET, threshold: float = 0.40, counts: dict[int, int] | None = None
) -> tuple[dict[int, float], bool]:
    """CLS1: n / (2 n_class) per class when the positive rate is below
    ``threshold``, else weight 1."""
    counts = class_counts(train, label) if counts is None else counts
    n = sum(counts.values())
    rate = counts.get(1, 0) / n if n else 0.0
    if rate < threshold and len(counts) > 1:
        return {k: n / (len(counts) * v) for k, v in counts.items()}, True
    return {k: 1.0 for k in counts}, False


def with_weights(df: DataFrame, weights: dict[int, float], label: str = TARGET, col: str = "weight") -> DataFrame:
    w = None
    for k, v in weights.items():
        cond = F.col(label).cast("int") == k
        w = F.when(cond, F.lit(v)) if w is None else w.when(cond, F.lit(v))
    return df.withColumn(col, w.otherwise(F.lit(1.0)) if w is not None else F.lit(1.0))


def dense_index(df: DataFrame, col: str = "__idx") -> DataFrame:
    """0..n-1 index without a global window: position within the partition
    (from ``monotonically_increasing_id``) plus the row count of all earlier
    partitions (one row per partition). ``df`` should be materialized first
    so that the order inside partitions is stable on recomputation."""
    tagged = df.withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    from pyspark.sql import Window

    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
    )
    return join_bounded(tagged, offsets, "__pid").withColumn(col, F.col("__off") + pos).drop("__pid", "__mid", "__off")


def oversample_minority(train: DataFrame, label: str = TARGET, seed: int = 42) -> tuple[DataFrame, dict]:
    """CLS2: append exactly n_major - n_minor minority rows drawn with
    replacement (hash of draw number and seed -> dense minority index);
    no-op with one class or equal sizes. Returns (rows, sizes)."""
    from ..session import cut_lineage

    counts = class_counts(train, label)
    sizes = {"n_major": 0, "n_minor": 0, "extra": 0, "total": sum(counts.values()), "used": False}
    if len(counts) < 2:
        return train, sizes
    major = max(counts, key=lambda k: (counts[k], -k))
    minor = min(counts, key=lambda k: (counts[k], k))
    n_maj, n_min = counts[major], counts[minor]
    sizes.update(n_major=n_maj, n_minor=n_min)
    if n_min == 0 or n_min == n_maj:
        return train, sizes
    extra = n_maj - n_min
    minority = cut_lineage(train.filter(F.col(label).cast("int") == minor))
    indexed = dense_index(minority)
    spark = train.sparkSession
    draws = spark.range(extra).select(F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(n_min)).alias("__idx"))
    drawn = draws.join(indexed, "__idx").drop("__idx")
    sizes.update(extra=extra, total=sizes["total"] + extra, used=True)
    return train.unionByName(drawn.select(*train.columns)), sizes
