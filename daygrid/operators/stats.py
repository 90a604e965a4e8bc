"""Exact quantiles and ordered prefix sums that never gather a whole column
(or a whole ordering) in one task.

``percentile``/``median`` as an aggregate merges one value map per group in a
single task: fine per entity (a group holds at most one row per day) but not
for a global quantile over billions of rows. ``exact_quantiles`` selects the wanted ranks
instead, of all columns at once. A round takes cut points from the data (approximate
quantiles; only their balance depends on the approximation), counts the values
equal to each cut point and between neighbours, and goes on with the ranges that hold a
wanted rank, until each holds one value. Cut points have counts of their own, so a
value that many rows share is found at once, and a range between them holds about
1/``buckets`` of its rows: the rounds are the logarithm of the rows to that base. Counts are
combined before they are shuffled; the driver gets ``buckets`` numbers a range.

Quantiles interpolate linearly between order statistics (numpy / pandas / SQL
``quantile_cont``), nulls and NaN ignored.

``prefix_sums`` gives running totals along a global order without a global
window: cut points of the order are taken once, as data, and assign every row to
a bucket by expression; bucket totals become offsets, running sums are taken
within buckets. No result depends on how Spark partitions an execution.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cut points of a range and round.
BUCKETS = 512


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    packed = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    return df.select(F.inline(packed)).filter(F.col("v").isNotNull() & ~F.isnan(F.col("v")))


@dataclass
class _Range:
    """Values of one column that may be wanted: ``lo`` <= v <= ``hi``, ``below`` rows before them."""

    column: int
    ranks: list[int]
    lo: float = -math.inf
    hi: float = math.inf
    below: int = 0


def _by_key(entries: dict[int, Column]) -> Column:
    return F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)])


def _in_ranges(values: DataFrame, ranges: list[_Range]) -> DataFrame:
    """(r, v): values with the number of their range (ranges of a column are apart)."""
    own: dict[int, list[Column]] = {}
    for i, r in enumerate(ranges):
        own.setdefault(r.column, []).append(F.struct(F.lit(r.lo).alias("lo"), F.lit(r.hi).alias("hi"), F.lit(i).alias("r")))
    mine = F.try_element_at(_by_key({c: F.array(*of) for c, of in own.items()}), F.col("c"))
    found = F.filter(mine, lambda x: (F.col("v") >= x["lo"]) & (F.col("v") <= x["hi"]))
    return values.select(F.get(found, F.lit(0))["r"].alias("r"), "v").filter(F.col("r").isNotNull())


def _place(v: Column, cuts: Column, buckets: int) -> Column:
    """Twice the number of cut points below ``v``, and one more if it is one itself."""
    steps = F.array(*[F.lit(1 << b) for b in range(buckets.bit_length(), -1, -1)])
    below = F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= F.size(cuts)) & (F.get(cuts, k + s - 1) < v), k + s).otherwise(k))
    return F.get(F.transform(F.array(below), lambda k: 2 * k + F.coalesce((F.get(cuts, k) == v).cast("int"), F.lit(0))), F.lit(0))


def _select(values: DataFrame, probs: Sequence[float], columns: int, buckets: int) -> tuple[dict[tuple[int, int], float], dict[int, int]]:
    """{(column, rank): value} for the ranks next to all ``probs``, and {column: number of values}."""
    found: dict[tuple[int, int], float] = {}
    sizes: dict[int, int] = {}
    ranges = [_Range(c, []) for c in range(columns)]
    while ranges:
        inside = _in_ranges(values, ranges)
        at = F.array(*[F.lit(i / buckets) for i in range(buckets + 1)])
        taken = inside.groupBy("r").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("v", at, F.lit(4 * buckets)).alias("cuts")).collect()
        if not taken:
            break
        for t in taken:
            r = ranges[t["r"]]
            if r.column not in sizes:  # the first round's range is the whole column
                sizes[r.column] = t["n"]
                r.ranks = sorted({k for p in probs for h in [(t["n"] - 1) * p] for k in (math.floor(h), math.ceil(h))})
        cuts = _by_key({t["r"]: F.array(*map(F.lit, sorted(set(t["cuts"])))) for t in taken})
        placed = inside.withColumn("place", _place(F.col("v"), F.try_element_at(cuts, F.col("r")), buckets))
        counted = placed.groupBy("r", "place").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        narrower, below = [], {i: r.below for i, r in enumerate(ranges)}
        for part in sorted(counted, key=lambda x: (x["r"], x["place"])):
            column, start = ranges[part["r"]].column, below[part["r"]]
            below[part["r"]] += part["n"]
            here = [k for k in ranges[part["r"]].ranks if start <= k < start + part["n"]]
            if here and part["lo"] == part["hi"]:
                found |= {(column, k): part["lo"] for k in here}
            elif here:
                narrower.append(_Range(column, here, part["lo"], part["hi"], start))
        ranges = narrower
    return found, sizes


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.5,), buckets: int = BUCKETS) -> dict[tuple[str, float], float | None]:
    """Exact linear-interpolated quantiles ``{(col, p): value}``; None for a column without values."""
    cols = list(dict.fromkeys(cols))
    found, sizes = _select(_long(df, cols), probs, len(cols), buckets) if cols else ({}, {})
    result: dict[tuple[str, float], float | None] = {}
    for i, c in enumerate(cols):
        for p in probs:
            if i not in sizes:
                result[c, p] = None
                continue
            h = (sizes[i] - 1) * p
            a, b = found[i, math.floor(h)], found[i, math.ceil(h)]
            result[c, p] = a if a == b else a + (h - math.floor(h)) * (b - a)
    return result


def exact_medians(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    """Interpolated median of each column (pandas / SQL ``median``)."""
    q = exact_quantiles(df, cols, (0.5,), **kw)
    return {c: q[(c, 0.5)] for c in cols}


def _resolve(cands: DataFrame, targets: Sequence[str], state: dict) -> None:
    counted = cands.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("t").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = counted.withColumn("hi", F.sum("n").over(w)).withColumn("lo", F.col("hi") - F.col("n"))
    cond = None
    for t in targets:
        r = state[t]["k"] - state[t]["below"]
        term = (F.col("t") == t) & (F.col("lo") <= r) & (F.col("hi") > r)
        cond = term if cond is None else cond | term
    for row in cum.filter(cond).select("t", "v").collect():
        state[row["t"]]["value"] = row["v"]


# ---------------------------------------------------------------------------
# Prefix sums along a global order
# ---------------------------------------------------------------------------


def order_cuts(df: DataFrame, order: str, n: int) -> list:
    """At most ``n - 1`` increasing cut points that split ``order`` about evenly
    (approximate quantiles of all rows; only their balance depends on the
    approximation, never a result)."""
    if n < 2:
        return []
    cuts = df.agg(F.percentile_approx(order, F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(20 * n))).first()[0]
    return sorted(set(cuts or []))


def bucket_of(order: Column, cuts: Sequence) -> Column:
    """Number of cut points that are at most ``order`` (a binary search); a pure
    function of the value, so every evaluation deals rows out alike."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda k, s: F.when((k + s <= len(cuts)) & (F.get(bounds, k + s - 1) <= order), k + s).otherwise(k))


def prefix_sums(
    df: DataFrame, order: Sequence, sums: Sequence[str], ascending: bool = True, partitions: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<c>_cum`` (inclusive running sum along ``order``, one column, within
    each ``by`` group) for each column in ``sums``. ``order`` must be unique per
    row of a group (e.g. distinct scores).

    Cut points taken once as data give every row its bucket; bucket totals (a row
    per group and bucket) become offsets, running sums are taken inside buckets."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (key,) = order
    col = F.col(key)
    direction, bucket_order = (col.asc(), F.col("__b").asc()) if ascending else (col.desc(), F.col("__b").desc())
    dealt = df.withColumn("__b", bucket_of(col, order_cuts(df, key, n)))
    groups = [*by, "__b"]
    totals = dealt.groupBy(*groups).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    before = Window.partitionBy(*by).orderBy(bucket_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias(f"__k_{g}") for g in groups], *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sums])
    inside = Window.partitionBy(*groups).orderBy(direction).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dealt.withColumns({f"__w_{c}": F.sum(c).over(inside) for c in sums})
    same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"__k_{g}")) for g in groups])
    out = within.join(offsets, same, "left").withColumns({f"{c}_cum": F.col(f"__w_{c}") + F.col(f"__o_{c}") for c in sums})
    return out.select(*df.columns, *[f"{c}_cum" for c in sums])
