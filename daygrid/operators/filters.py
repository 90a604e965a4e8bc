"""Row filters (FLT1-FLT10)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_text
from ..session import cut_lineage
from .joins import is_small, join_small


def _as_date(v):
    if v is None or isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v.date())
    if isinstance(v, _dt.date):
        return F.lit(v)
    return F.to_date(F.lit(str(v)))


def clip_dates(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """FLT1: inclusive date clip, either bound optional (pushed to the scan)."""
    c = F.col(col)
    if start is not None:
        df = df.filter(c >= _as_date(start))
    if end is not None:
        df = df.filter(c <= _as_date(end))
    return df


def keep_matching_or_all(df: DataFrame, match: Column, by: Sequence[str] | None = None, on: Sequence[str] | None = None) -> DataFrame:
    """FLT2-FLT4: keep rows where ``match`` holds, unless none match (then keep all).

    The "any row matches" fact is a one-row aggregate used as a scalar
    subquery (global form); with ``by`` the groups that have a match are written once
    and joined back, broadcast only if few (counted). No global window, nothing collected.
    ``on`` names the columns that ``match`` reads: it is then decided once for each of their
    values in a group, and rows are semi-joined with the kept values if these are few (counted).
    """
    flag = "__match"
    marked = df.withColumn(flag, F.coalesce(match, F.lit(False)))
    if not by:
        any_match = marked.agg(F.max(F.col(flag).cast("int")).alias("m")).select(
            F.coalesce(F.col("m"), F.lit(0)) == 1
        )
        return marked.filter(F.col(flag) | ~any_match.scalar()).drop(flag)
    if on:
        cols = list(dict.fromkeys([*by, *on]))
        values = cut_lineage(df.select(*cols).distinct().withColumn(flag, F.coalesce(match, F.lit(False))))
        if is_small(values):
            none = ~F.max(flag).over(Window.partitionBy(*by)) | reduce(lambda a, b: a | b, [F.col(b).isNull() for b in by])
            kept = values.withColumn("__none", none).filter(F.col(flag) | F.col("__none")).select(*[F.col(c).alias(f"__v_{c}") for c in cols])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__v_{c}")) for c in cols])
            return df.join(F.broadcast(kept), same, "left_semi")
    any_match = marked.filter(F.col(flag)).select(*by).distinct().withColumn("__any", F.lit(True))
    flagged = join_small(marked, any_match, list(by), "left", materialize=True)
    return flagged.filter(F.col(flag) | F.col("__any").isNull()).drop(flag, "__any")


def text_contains_filter(df: DataFrame, col: str, needle_regex: str, by: Sequence[str] | None = None) -> DataFrame:
    """FLT2/FLT3 convenience: normalized ``col`` matches ``needle_regex``, with fallback."""
    return keep_matching_or_all(df, normalize_text(F.col(col)).rlike(needle_regex), by)


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT5."""
    return df.na.drop(subset=list(cols))


def negative_to_null(c: Column) -> Column:
    """FLT6: negative values are invalid."""
    return F.when(c >= 0, c)


def non_empty_key(df: DataFrame, key: str) -> DataFrame:
    """FLT7: rows whose key is null or '' are removed."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def in_date_set(df: DataFrame, date_col: str, dates: DataFrame, dates_col: str = "date") -> DataFrame:
    """FLT9: rows whose day is in a set of days (left-semi join)."""
    days = dates.select(F.col(dates_col).alias("__d")).distinct()
    keyed = df.withColumn("__d", F.to_date(F.col(date_col)))
    return join_small(keyed, days, "__d", "left_semi").drop("__d")


def class_rows(df: DataFrame, label_col: str, k: int) -> DataFrame:
    """FLT10."""
    return df.filter(F.col(label_col) == k)
