"""Date and time expressions: lenient parsing, day floor, calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .text import ColumnOrName, _col, strip_ws

# Patterns tried after the ISO cast, in order (month-first before day-first, as
# a month-first parser would do for ambiguous dates). One-digit fields, 24- and
# 12-hour times and month names are understood; the time is optional.
_TIME = "[ H:mm[:ss]]"
_HALF = " h:mm[:ss] a"
TIMESTAMP_PATTERNS = (
    "yyyy/M/d" + _TIME,
    *(f"{day}{time}" for sep in "/-." for day in (f"M{sep}d{sep}yyyy", f"d{sep}M{sep}yyyy") for time in (_TIME, _HALF)),
    "yyyyMMdd",
    *(f"{day}{time}" for day in ("MMM d yyyy", "MMM d, yyyy", "d MMM yyyy", "MMMM d yyyy", "MMMM d, yyyy", "d MMMM yyyy") for time in (_TIME, _HALF)),
)


def lenient_timestamp(c: ColumnOrName, data_type=None) -> Column:
    """DAT1: any value -> TIMESTAMP_NTZ; unparsable -> null; zone dropped, wall time kept.

    ``data_type`` is the input column's Spark type when known; typed
    timestamp/date inputs are cast directly, strings go through the ISO cast
    (which drops an offset keeping the wall time) and then fixed patterns.
    """
    col = _col(c)
    if isinstance(data_type, (TimestampNTZType, TimestampType, DateType)):
        return col.cast("timestamp_ntz")
    text = strip_ws(col.cast("string"))
    tries = [text.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in TIMESTAMP_PATTERNS]
    return F.coalesce(*tries)


def day_floor(c: ColumnOrName) -> Column:
    """DAT2: timestamp -> date."""
    return F.to_date(_col(c))


def calendar_columns(date_col: str = "date") -> dict[str, Column]:
    """DAT3: year, month, day, day of year, day of week (Monday=0), weekend flag."""
    d = F.col(date_col)
    dow = F.weekday(d)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "day_of_year": F.dayofyear(d).cast("int"),
        "day_of_week": dow.cast("int"),
        "is_weekend": (dow >= 5).cast("int"),
    }


def day_sequence(start: Column, end: Column) -> Column:
    """DAT4: exploded inclusive day sequence between two dates."""
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def unparsed_count(df, column: str):
    """One row: values of ``column`` and how many of them are no date (``values``,
    ``unparsed``), so that rows lost to odd spellings are reported."""
    raw = F.col(column).cast("string")
    given = raw.isNotNull() & (strip_ws(raw) != "")
    return df.agg(F.count_if(given).alias("values"), F.count_if(given & lenient_timestamp(column, df.schema[column].dataType).isNull()).alias("unparsed"))
