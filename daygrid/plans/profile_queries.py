"""Registered profiling queries (QLT1-QLT11, TOP1-TOP3, TOP6) over the built
panel before imputation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

from ..operators import profile as P
from ..operators.panel import sort_panel
from ..schema import DATE, KEY, NAME, TARGET
from .panel_ops_queries import CTE_PANEL, LEVEL_COLS, PANEL_NUMERIC, RAIN_NAMES, WEATHER_COLS, _r, full_panel
from ..session import cut_lineage
from .registry import query

PANEL_COLUMNS = [
    KEY, DATE, NAME, "stations_in_municipio", "latitud_raw", *WEATHER_COLS, *RAIN_NAMES, *LEVEL_COLS, TARGET,
    "year", "month", "day", "day_of_year", "day_of_week", "is_weekend",
]
NUMERIC_WITH_TARGET = [c for c in PANEL_COLUMNS if c in PANEL_NUMERIC or c == TARGET]
# Columns binned by the registered histogram: sums and maxima are exact in
# both engines; a per-day mean can differ in its last bit between engines and
# move a value sitting exactly on a bin edge, so means are left to callers.
HIST_COLS = [
    "precip_mm_24h_sum", "precip_mm_48h_sum", "precip_mm_72h_sum",
    "meteo_temp_max_24h", "meteo_rh_max_24h", "meteo_wind_max_24h", "river_level_max_24h",
]
BOX_COLS = [
    "precip_mm_24h_sum", "precip_mm_72h_sum", "meteo_temp_max_24h", "meteo_rh_max_24h",
    "meteo_wind_max_24h", "river_level_max_24h",
]
CORR_COLS = ["stations_in_municipio", "latitud_raw", *WEATHER_COLS, *RAIN_NAMES, *LEVEL_COLS]


@query(
    "panel_summary",
    f"""
WITH {CTE_PANEL}
SELECT count(*) AS rows, {len(PANEL_COLUMNS)} AS n_columns, count(DISTINCT municipio_key) AS n_entities,
       min(date) AS date_min, max(date) AS date_max
FROM panel
""",
)
def panel_summary(spark: SparkSession, d: str) -> DataFrame:
    """QLT1: shape, entities and date range of the panel."""
    return P.panel_summary(full_panel(spark, d))


_NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 3) AS null_pct FROM panel"
    for c in PANEL_COLUMNS
)


@query("null_profile", f"WITH {CTE_PANEL} {_NULLS_SQL}")
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    """QLT2: null count and percent of every column."""
    return P.null_profile(full_panel(spark, d))


@query(
    "columns_by_nulls",
    f"WITH {CTE_PANEL}, np AS ({_NULLS_SQL}) SELECT * FROM np ORDER BY null_count DESC, column_name LIMIT 25",
)
def columns_by_nulls(spark: SparkSession, d: str) -> DataFrame:
    """TOP6: the 25 columns with most nulls."""
    return P.columns_by_nulls(full_panel(spark, d), 25)


@query(
    "near_zero_variance",
    f"""
WITH {CTE_PANEL}
{' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, min({c}) = max({c}) AS single_value, "
    f"(count({c}) = 0 OR coalesce(min({c}) = max({c}), false) OR coalesce(var_samp(CAST({c} AS DOUBLE)) < 1e-10, false)) AS near_zero FROM panel"
    for c in NUMERIC_WITH_TARGET)}
""",
)
def near_zero_variance(spark: SparkSession, d: str) -> DataFrame:
    """QLT3: empty, single-valued or (almost) zero-variance numeric columns."""
    p = full_panel(spark, d)
    return P.near_zero_variance(p, NUMERIC_WITH_TARGET).select("column_name", "non_null", "single_value", "near_zero")


@query(
    "duplicate_rows",
    f"""
WITH {CTE_PANEL}
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM panel)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM panel)) AS duplicates
FROM panel
""",
)
def duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    """QLT4: full-row duplicates."""
    return P.duplicate_rows(full_panel(spark, d))


@query(
    "duplicate_keys",
    f"""
WITH {CTE_PANEL}, k AS (SELECT municipio_key, date, count(*) AS n FROM panel GROUP BY municipio_key, date)
SELECT count(*) AS distinct_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_keys FROM k
""",
)
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """QLT5: duplicates on (entity, day) — the panel uniqueness guard (T1)."""
    return P.duplicate_keys(full_panel(spark, d))


@query(
    "target_distribution",
    f"""
WITH {CTE_PANEL},
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE flood_next_24h IS NULL) AS nulls,
             avg(coalesce(CAST(flood_next_24h AS DOUBLE), 0.0)) AS rate FROM panel)
SELECT CAST(flood_next_24h AS DOUBLE) AS value, count(*) AS rows, round(count(*) / any_value(t.n), 6) AS share,
       any_value(t.nulls) AS target_nulls, round(any_value(t.rate), 6) AS positive_rate
FROM panel CROSS JOIN t GROUP BY flood_next_24h
""",
)
def target_distribution(spark: SparkSession, d: str) -> DataFrame:
    """QLT6 + QLT7: class counts, shares, null count and positive rate."""
    return P.target_distribution(full_panel(spark, d))


def _sql_hist(cols, bins, source, by=None) -> str:
    g = f"{by}, " if by else ""
    gj = f" AND l.{by} = r.{by}" if by else ""
    long = " UNION ALL ".join(f"SELECT {g}'{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM {source}" for c in cols)
    return f"""
lg AS (SELECT * FROM ({long}) WHERE v IS NOT NULL AND NOT isnan(v)),
rg0 AS (SELECT {g}column_name, min(v) AS lo, max(v) AS hi FROM lg GROUP BY {g}column_name),
rg AS (SELECT {g}column_name, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM rg0),
hb AS (
  SELECT {'l.' + by + ', ' if by else ''}l.column_name, r.lo, r.hi,
         CAST(least(floor((l.v - r.lo) * ({float(bins)} / (r.hi - r.lo))), {bins - 1}) AS INTEGER) AS bin
  FROM lg l JOIN rg r ON l.column_name = r.column_name{gj}
),
hist AS (
  SELECT {g}column_name, bin, round(lo + bin * ((hi - lo) / {bins}), 6) + 0.0 AS bin_lo,
         round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) + 0.0 AS bin_hi, count(*) AS count
  FROM hb GROUP BY {g}column_name, lo, hi, bin
)"""


@query("histogram_40", f"WITH {CTE_PANEL}, {_sql_hist(HIST_COLS, 40, 'panel')} SELECT * FROM hist")
def histogram_40(spark: SparkSession, d: str) -> DataFrame:
    """QLT8: 40 equal-width bins per feature (the last bin closed)."""
    return P.histogram(full_panel(spark, d), HIST_COLS, 40)


def _sql_corr() -> str:
    parts = []
    for a, b in combinations(CORR_COLS, 2):
        cond = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        r = (
            f"CASE WHEN var_pop({a}) FILTER (WHERE {cond}) > 0 AND var_pop({b}) FILTER (WHERE {cond}) > 0 "
            f"THEN round(corr({a}, {b}) FILTER (WHERE {cond}), 6) + 0.0 END"
        )
        parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {r} AS corr FROM panel")
        parts.append(f"SELECT '{b}' AS a, '{a}' AS b, {r} AS corr FROM panel")
    parts += [f"SELECT '{c}' AS a, '{c}' AS b, 1.0 AS corr" for c in CORR_COLS]
    return " UNION ALL ".join(parts)


@query("correlation_matrix", f"WITH {CTE_PANEL} {_sql_corr()}")
def correlation_matrix(spark: SparkSession, d: str) -> DataFrame:
    """QLT9: Pearson correlation of the first 20 numeric columns with more
    than one value, all pairs in one aggregate."""
    p = cut_lineage(full_panel(spark, d))  # read twice: column choice, then pairs
    numeric = [c for c in p.columns if c in NUMERIC_WITH_TARGET]
    cols = P.varying_columns(p, numeric)[:20]
    return P.correlation_matrix(p, cols)


@query(
    "daily_coverage",
    f"""
WITH {CTE_PANEL}
SELECT date AS day, count(*) AS records, round(avg(CAST(flood_next_24h AS DOUBLE)), 6) AS positive_rate
FROM panel GROUP BY date
""",
)
def daily_coverage(spark: SparkSession, d: str) -> DataFrame:
    """QLT10: records and positive rate per day."""
    return P.daily_coverage(full_panel(spark, d))


@query(
    "top20_entities",
    f"""
WITH {CTE_PANEL}
SELECT municipio_name, count(*) AS rows FROM panel GROUP BY municipio_name ORDER BY rows DESC, municipio_name LIMIT 20
""",
)
def top20_entities(spark: SparkSession, d: str) -> DataFrame:
    """TOP3: the 20 entities with most rows."""
    return P.top_entities(full_panel(spark, d), 20)


def _sql_box() -> str:
    qs = ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.5) AS {c}_q2, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in BOX_COLS
    )
    rows = []
    for c in BOX_COLS:
        lo = f"(q.{c}_q1 - 1.5 * (q.{c}_q3 - q.{c}_q1))"
        hi = f"(q.{c}_q3 + 1.5 * (q.{c}_q3 - q.{c}_q1))"
        rows.append(
            f"SELECT '{c}' AS column_name, round(any_value(q.{c}_q1), 6) AS q1, round(any_value(q.{c}_q2), 6) AS median, "
            f"round(any_value(q.{c}_q3), 6) AS q3, round(min({c}) FILTER (WHERE {c} >= {lo} AND {c} <= {hi}), 6) AS whisker_lo, "
            f"round(max({c}) FILTER (WHERE {c} >= {lo} AND {c} <= {hi}), 6) AS whisker_hi, "
            f"count({c}) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS outliers FROM panel CROSS JOIN q"
        )
    return f"q AS (SELECT {qs} FROM panel) " + " UNION ALL ".join(rows)


@query("box_stats", f"WITH {CTE_PANEL}, {_sql_box()}")
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    """QLT11: quartiles, whiskers and outlier counts."""
    return P.box_stats(full_panel(spark, d), BOX_COLS)


_SELECT_PANEL = ", ".join(_r(c) if c in PANEL_NUMERIC and c not in ("year", "month", "day", "day_of_year", "day_of_week", "is_weekend") else c for c in PANEL_COLUMNS)


@query(
    "preview_rows",
    f"""
WITH {CTE_PANEL}
SELECT * FROM (SELECT {_SELECT_PANEL}, 'head' AS part FROM panel ORDER BY municipio_key, date LIMIT 5)
UNION ALL
SELECT * FROM (SELECT {_SELECT_PANEL}, 'tail' AS part FROM panel ORDER BY municipio_key DESC, date DESC LIMIT 5)
""",
)
def preview_rows(spark: SparkSession, d: str) -> DataFrame:
    """TOP2: the first and last 5 rows in (entity, day) order."""
    return P.preview_rows(full_panel(spark, d), 5)


@query("panel_sorted", f"WITH {CTE_PANEL} SELECT {_SELECT_PANEL} FROM panel ORDER BY municipio_key, date")
def panel_sorted(spark: SparkSession, d: str) -> DataFrame:
    """TOP1: the panel in its final (entity, day) order."""
    return sort_panel(full_panel(spark, d))
