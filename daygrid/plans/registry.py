"""Query registry: name -> (Spark builder, DuckDB twin SQL or None).

Registered builders take ``(spark, sf_dir)`` and return a DataFrame over the
whole driver tables. Double columns are rounded to 6 places on both sides so
that summation order cannot change the value hash.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import configure

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    if not cols:
        return df
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in cols})


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from .analogues import forget_reads

            configure(spark)
            forget_reads()
            return rounded(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# ---------------------------------------------------------------------------
# DuckDB fragments for the twins
# ---------------------------------------------------------------------------


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_norm_text(x: str) -> str:
    return f"lower(strip_accents({sql_strip(f'coalesce(CAST({x} AS VARCHAR), {chr(39)}{chr(39)})')}))"


def sql_norm_key(x: str) -> str:
    return f"trim(regexp_replace({sql_norm_text(x)}, '[^a-z0-9]+', '_', 'g'), '_')"


def sql_clean_code(x: str) -> str:
    inner = f"regexp_replace({sql_strip(f'CAST({x} AS VARCHAR)')}, '\\.0+$', '')"
    return f"regexp_replace({inner}, '[^0-9A-Za-z]', '', 'g')"


def sql_round(x: str, places: int = 6) -> str:
    return f"round({x}, {places})"


def sql_calendar(d: str = "date") -> str:
    return (
        f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
        f"CAST(day({d}) AS INTEGER) AS day, CAST(dayofyear({d}) AS INTEGER) AS day_of_year, "
        f"CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week, "
        f"CAST(CASE WHEN isodow({d}) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"
    )
