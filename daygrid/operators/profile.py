"""Panel profiling (QLT1-QLT11, TOP2, TOP3, TOP6).

Every profile is one or two aggregates over the panel (wide ``agg`` then
``inline`` to long form), never a job per column.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, KEY, NAME, TARGET
from ..session import cut_lineage
from .joins import join_small
from .stats import exact_quantiles


def _long(cols: Sequence[str], fields: Sequence[str]) -> Column:
    return F.inline(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in cols]
        )
    )


def panel_summary(df: DataFrame, key: str = KEY, date: str = DATE) -> DataFrame:
    """QLT1: rows, columns, distinct entities, date range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(key).alias("n_entities"),
        F.min(date).alias("date_min"),
        F.max(date).alias("date_max"),
    )


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """QLT2: null count and percent (3 decimals) per column."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"{c}__null_count") for c in cols])
    return wide.select("__n", _long(cols, ["null_count"])).select(
        "column_name", "null_count", F.round(F.col("null_count") * 100.0 / F.col("__n"), 3).alias("null_pct")
    )


def columns_by_nulls(df: DataFrame, n: int = 25) -> DataFrame:
    """TOP6: columns with the most nulls (ties by name)."""
    return null_profile(df).orderBy(F.desc("null_count"), F.asc("column_name")).limit(n)


def near_zero_variance(df: DataFrame, cols: Sequence[str], threshold: float = 1e-10) -> DataFrame:
    """QLT3: a column is near-constant when empty, when it holds one distinct
    value (min == max, no distinct aggregate needed) or its sample variance is
    below ``threshold``."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__non_null"),
            F.min(x).alias(f"{c}__lo"),
            F.max(x).alias(f"{c}__hi"),
            F.var_samp(x).alias(f"{c}__var"),
        ]
    long = df.agg(*aggs).select(_long(cols, ["non_null", "lo", "hi", "var"]))
    constant = (F.col("non_null") == 0) | (F.col("lo") == F.col("hi"))
    return long.select(
        "column_name",
        "non_null",
        (F.col("lo") == F.col("hi")).alias("single_value"),
        F.col("var").alias("var_samp"),
        (constant | (F.coalesce(F.col("var") < threshold, F.lit(False)))).alias("near_zero"),
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """QLT4: rows minus distinct rows (full-row duplicates)."""
    n = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    d = df.distinct().agg(F.count(F.lit(1)).alias("d")).select("d").scalar()
    return df.sparkSession.range(1).select(n.alias("rows"), d.alias("distinct_rows"), (n - d).alias("duplicates"))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """QLT5: rows beyond the first per key (T1 guard)."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """QLT6 + QLT7: per class count and share, with null count and positive rate."""
    y = F.col(target).try_cast("double")
    totals = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y.isNull()).alias("nulls"), F.avg(F.coalesce(y, F.lit(0.0))).alias("rate")
    )
    per = df.groupBy(y.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    t = totals.select("n", "nulls", "rate")
    return per.select(
        "value",
        "rows",
        (F.col("rows") / t.select("n").scalar()).alias("share"),
        t.select("nulls").scalar().alias("target_nulls"),
        t.select("rate").scalar().alias("positive_rate"),
    )


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40, by: str | None = None) -> DataFrame:
    """QLT8 / EVL10: equal-width bins between each column's min and max
    (per ``by`` group when given); the maximum falls in the last bin, a
    constant column spans [v - 0.5, v + 0.5] like numpy."""
    group = [by] if by else []
    long = df.select(
        *group,
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])),
    ).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    rng = long.groupBy(*group, "column_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rng = rng.select(
        *group,
        "column_name",
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    j = join_small(long, rng, [*group, "column_name"], materialize=True)  # one row per (group, column)
    b = F.least(F.floor((F.col("v") - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))), F.lit(bins - 1))
    counted = j.groupBy(*group, "column_name", "lo", "hi", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select(
        *group,
        "column_name",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        "count",
    )


def varying_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns with more than one distinct non-null value (one min/max aggregate)."""
    row = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols]).collect()[0]
    return [c for c in cols if row[f"{c}__lo"] is not None and row[f"{c}__lo"] != row[f"{c}__hi"]]


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """QLT9: pairwise-complete Pearson correlation of every column pair.

    Columns are centred on their averages; each partition then sums, for all
    pairs at once, the co-moments of the rows where both are present (matrix
    products over null masks) and emits one record; records add up. A pair
    without variance yields null."""
    pairs = list(combinations(cols, 2))
    k = len(cols)
    means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([0.0 if m is None else m for m in means])
    names = ("n", "sx", "sxx", "sxy")

    def moments(batches):
        total = {m: np.zeros((k, k)) for m in names}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - centre
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            mask = there.astype(float)
            for m, (left, right) in zip(names, ((mask, mask), (x, mask), (x * x, mask), (x, x))):
                total[m] += left.T @ right
        yield pa.RecordBatch.from_arrays([pa.array([total[m].ravel().tolist()]) for m in names], names=list(names))

    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = doubles.mapInArrow(moments, ", ".join(f"{m} array<double>" for m in names))
    cell = parts.select(F.posexplode(F.arrays_zip(*names)).alias("at", "v")).groupBy("at").agg(*[F.sum(f"v.{m}").alias(m) for m in names])
    index = F.create_map(*[F.lit(v) for i, c in enumerate(cols) for v in (i, c)])
    cell = cell.select(F.floor(F.col("at") / k).cast("int").alias("i"), (F.col("at") % k).cast("int").alias("j"), *names)
    # sx and sxx of the other column of a pair stand in the transposed cell
    other = cell.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    mom = cell.filter("i < j AND n > 0").join(F.broadcast(other), ["i", "j"]).select(
        index[F.col("i")].alias("a"), index[F.col("j")].alias("b"), (F.col("sxy") - sx * sy / n).alias("cxy"), (F.col("sxx") - sx * sx / n).alias("vx"), (F.col("syy") - sy * sy / n).alias("vy")
    )
    tiny = 1e-12
    real = (F.col("vx") > tiny) & (F.col("vy") > tiny)
    upper = mom.select("a", "b", F.when(real, F.try_divide(F.col("cxy"), F.sqrt(F.col("vx") * F.col("vy")))).alias("corr"))
    spark = df.sparkSession
    everything = upper.unionByName(upper.select(F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, corr double")
    named = spark.createDataFrame([(a, b) for a, b in pairs] + [(b, a) for a, b in pairs], "a string, b string")
    # pairs with no complete row at all still appear, with a null correlation
    return named.join(everything, ["a", "b"], "left").unionByName(diag)


def daily_coverage(df: DataFrame, date: str = DATE, target: str = TARGET) -> DataFrame:
    """QLT10: records per day and positive rate per day."""
    return df.groupBy(F.to_date(date).alias("day")).agg(
        F.count(F.lit(1)).alias("records"), F.avg(F.col(target).cast("double")).alias("positive_rate")
    )


def top_entities(df: DataFrame, n: int = 20, name: str = NAME) -> DataFrame:
    """TOP3: entities with the most rows (ties by name)."""
    return (
        df.groupBy(F.col(name).cast("string").alias(name))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc(name))
        .limit(n)
    )


def box_stats(df: DataFrame, cols: Sequence[str], materialize: bool = True) -> DataFrame:
    """QLT11: quartiles (exact, distributed), 1.5 IQR whiskers at the farthest
    inside value, and the number of outliers per column. The input is read
    three times, so it is written once to the checkpoint folder first."""
    if materialize:
        df = cut_lineage(df)
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    aggs = []
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            aggs += [F.lit(None).cast("double").alias(f"{c}__{f}") for f in ("wlo", "whi")]
            aggs.append(F.lit(0).cast("long").alias(f"{c}__outliers"))
            continue
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        x = F.col(c).cast("double")
        inside = (x >= lo) & (x <= hi)
        aggs += [
            F.min(F.when(inside, x)).alias(f"{c}__wlo"),
            F.max(F.when(inside, x)).alias(f"{c}__whi"),
            F.count_if(x.isNotNull() & ~inside).alias(f"{c}__outliers"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(q[(c, 0.25)]).cast("double").alias("q1"),
            F.lit(q[(c, 0.5)]).cast("double").alias("median"),
            F.lit(q[(c, 0.75)]).cast("double").alias("q3"),
            F.col(f"{c}__wlo").alias("whisker_lo"),
            F.col(f"{c}__whi").alias("whisker_hi"),
            F.col(f"{c}__outliers").alias("outliers"),
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


def preview_rows(df: DataFrame, n: int = 5, keys: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """TOP2: first and last ``n`` rows in (key, date) order."""
    head = df.orderBy(*keys).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(*[F.desc(k) for k in keys]).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)
