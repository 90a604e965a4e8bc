"""Temporal split by distinct days (SPL1, SPL2, WIN7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, TARGET
from .stats import prefix_sums


def split_bounds(df: DataFrame, date_col: str = DATE, train: float = 0.70, validation: float = 0.85, min_days: int = 10) -> DataFrame:
    """One row: number of distinct days and the first validation / test day.

    train = first floor(0.70 n) days (at least 1), validation up to
    floor(0.85 n) (at least one day, leaving at least one test day). Days are
    ranked with distributed prefix sums, not a global window.
    """
    days = df.select(F.to_date(date_col).alias("day")).filter(F.col("day").isNotNull()).distinct()
    ranked = prefix_sums(days.withColumn("one", F.lit(1)), ["day"], ["one"]).withColumnRenamed("one_cum", "rank")
    n = days.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    train_end = F.greatest(F.floor(n * F.lit(train)), F.lit(1))
    val_end = F.least(F.greatest(train_end + 1, F.floor(n * F.lit(validation))), n - 1)
    b = ranked.agg(
        F.max(F.when(F.col("rank") == train_end + 1, F.col("day"))).alias("first_validation_day"),
        F.max(F.when(F.col("rank") == val_end + 1, F.col("day"))).alias("first_test_day"),
    )
    guard = F.when(n < min_days, F.raise_error(F.lit(f"too few distinct days for a temporal split (< {min_days})")))
    return b.select(
        F.coalesce(guard.cast("date"), F.col("first_validation_day")).alias("first_validation_day"),
        "first_test_day",
        n.alias("n_days"),
    )


def split_column(bounds: DataFrame, date_col: str = DATE) -> Column:
    """'train' / 'validation' / 'test' from the boundary days (scalar subqueries)."""
    b1 = bounds.select("first_validation_day").scalar()
    b2 = bounds.select("first_test_day").scalar()
    day = F.to_date(date_col)
    return F.when(day < b1, F.lit("train")).when(day < b2, F.lit("validation")).otherwise(F.lit("test"))


def temporal_split(df: DataFrame, date_col: str = DATE, **kw) -> DataFrame:
    """SPL1: rows with a non-null day, labelled with their split."""
    rows = df.filter(F.to_date(date_col).isNotNull())
    return rows.withColumn("split", split_column(split_bounds(rows, date_col, **kw), date_col))


def split_report(df: DataFrame, date_col: str = DATE, target: str = TARGET) -> DataFrame:
    """SPL2: per split first/last day, distinct days, rows and positive rate."""
    y = F.coalesce(F.col(target).try_cast("int"), F.lit(0))
    return df.groupBy("split").agg(
        F.min(F.to_date(date_col)).alias("date_min"),
        F.max(F.to_date(date_col)).alias("date_max"),
        F.count_distinct(F.to_date(date_col)).alias("n_days"),
        F.count(F.lit(1)).alias("rows"),
        F.avg(y.cast("double")).alias("positive_rate"),
    )
