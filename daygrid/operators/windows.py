"""Time-series window operators over a per-entity daily table (WIN1-WIN4).

Windows are partitioned by entity only on data already reduced to one row per
(entity, day), so a partition never holds more than the calendar length.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..schema import DATE, KEY


def rolling_sum(col: str, n: int, key: str = KEY, date: str = DATE, frame: str = "rows") -> Column:
    """WIN1/WIN2: sum of the last ``n`` rows (``frame='rows'``, reference) or the
    last ``n`` calendar days (``frame='days'``), minimum one row."""
    if frame == "rows":
        w = Window.partitionBy(key).orderBy(date).rowsBetween(-(n - 1), Window.currentRow)
    elif frame == "days":
        day_no = F.unix_date(F.col(date))
        w = Window.partitionBy(key).orderBy(day_no).rangeBetween(-(n - 1), Window.currentRow)
    else:
        raise ValueError(f"frame must be 'rows' or 'days', got {frame!r}")
    return F.sum(F.col(col)).over(w)


def lag_delta(col: str, key: str = KEY, date: str = DATE) -> Column:
    """WIN3: value minus the previous row's value; first row is null."""
    w = Window.partitionBy(key).orderBy(date)
    return F.col(col) - F.lag(F.col(col), 1).over(w)


def shift_days(date_col: str, days: int) -> Column:
    """WIN4: move a day key by ``days`` (negative = earlier)."""
    return F.date_add(F.col(date_col), days)
