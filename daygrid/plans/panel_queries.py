"""Registered panel queries over the driver tables (flagship and its parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates as A
from ..operators.grid import date_bounds, entity_reference
from ..operators.panel import assemble
from ..schema import KEY, NAME
from ..session import cut_all
from . import analogues as S
from .registry import query, sql_calendar, sql_clean_code, sql_norm_key, sql_norm_text, sql_strip

# ---------------------------------------------------------------------------
# Shared Spark pieces
# ---------------------------------------------------------------------------


def _catalogue(spark, d, region=None):
    return A.prepare_catalogue(S.catalogue(spark, d), region)


def _daily_events(spark, d, region=None):
    return A.daily_events(S.event_log(spark, d), S.URGENT, region)


def flagship_panel(spark: SparkSession, d: str) -> DataFrame:
    """Entity-day panel: static catalogue attributes, daily rain block with
    2/3-row rolling sums, next-day label and calendar on the dense grid."""
    cat = _catalogue(spark, d)
    smap = A.station_map(cat)
    static = A.static_attributes(cat)
    daily, rain = cut_all(_daily_events(spark, d), A.daily_rain(S.rain_readings(spark, d), smap))
    label = A.next_day_label(daily)
    entities = entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))
    bounds = date_bounds([label, rain])
    return assemble(entities, static, bounds, [rain], label)


# ---------------------------------------------------------------------------
# Shared SQL pieces (DuckDB)
# ---------------------------------------------------------------------------

CTE_CAT = f"""
cat AS (
  SELECT {sql_clean_code('s.s_suppkey')} AS station_code,
         {sql_strip('n.n_name')} AS municipio_name,
         {sql_norm_key(sql_strip('n.n_name'))} AS municipio_key,
         r.r_name AS departamento_raw,
         CAST(s.s_acctbal AS DOUBLE) AS latitud_raw
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE {sql_norm_key(sql_strip('n.n_name'))} <> ''
),
smap AS (
  SELECT DISTINCT station_code, municipio_key FROM cat
  WHERE station_code IS NOT NULL AND station_code <> ''
),
static AS (
  SELECT municipio_key, count(DISTINCT station_code) AS stations_in_municipio,
         avg(latitud_raw) AS latitud_raw
  FROM cat GROUP BY municipio_key
)"""

CTE_EVENTS = f"""
ev AS (
  SELECT {sql_strip('n.n_name')} AS municipio_name,
         {sql_norm_key(sql_strip('n.n_name'))} AS municipio_key,
         CAST(o.o_orderdate AS DATE) AS date,
         CASE WHEN contains({sql_norm_text('o.o_orderpriority')}, 'urgent') THEN 1 ELSE 0 END AS flag
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderdate IS NOT NULL
),
daily AS (
  SELECT municipio_key, date, max(flag) AS flood_event_today,
         CAST(sum(flag) AS BIGINT) AS flood_events_count_today, min(municipio_name) AS municipio_name
  FROM ev WHERE municipio_key <> '' GROUP BY municipio_key, date
),
label AS (
  SELECT municipio_key, date - 1 AS date, flood_event_today AS flood_next_24h FROM daily
)"""

CTE_RAIN = f"""
rr AS (
  SELECT {sql_clean_code('l_suppkey')} AS station_code, CAST(l_shipdate AS DATE) AS date,
         CAST(l_quantity AS DOUBLE) AS precip
  FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity >= 0
),
rd AS (
  SELECT m.municipio_key, rr.date, sum(precip) AS precip_mm_24h_sum, max(precip) AS precip_mm_24h_max,
         count(*) AS precip_obs_count_24h, count(DISTINCT rr.station_code) AS precip_station_count_24h
  FROM rr JOIN smap m ON rr.station_code = m.station_code GROUP BY m.municipio_key, rr.date
),
rain AS (
  SELECT *,
    sum(precip_mm_24h_sum) OVER (PARTITION BY municipio_key ORDER BY date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS precip_mm_48h_sum,
    sum(precip_mm_24h_sum) OVER (PARTITION BY municipio_key ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS precip_mm_72h_sum
  FROM rd
)"""

CTE_ENTITIES = """
ents AS (
  SELECT municipio_key, municipio_name FROM (
    SELECT municipio_key, municipio_name,
           row_number() OVER (PARTITION BY municipio_key ORDER BY p, d NULLS FIRST, municipio_name) AS rn
    FROM (SELECT municipio_key, municipio_name, 0 AS p, date AS d FROM daily
          UNION ALL SELECT municipio_key, municipio_name, 1 AS p, NULL AS d FROM cat)
  ) WHERE rn = 1
)"""


def cte_grid(*sources: str) -> str:
    parts = " UNION ALL ".join(f"SELECT min(date) AS lo, max(date) AS hi FROM {s}" for s in sources)
    return f"""
bounds AS (SELECT min(lo) AS lo, max(hi) AS hi FROM ({parts})),
grid AS (
  SELECT e.municipio_key, e.municipio_name, CAST(g.d AS DATE) AS date
  FROM ents e CROSS JOIN bounds b
  CROSS JOIN LATERAL (SELECT unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g
)"""


RAIN_COLS = """round(r.precip_mm_24h_sum, 6) AS precip_mm_24h_sum, round(r.precip_mm_24h_max, 6) AS precip_mm_24h_max,
  r.precip_obs_count_24h, r.precip_station_count_24h,
  round(r.precip_mm_48h_sum, 6) AS precip_mm_48h_sum, round(r.precip_mm_72h_sum, 6) AS precip_mm_72h_sum"""

FLAGSHIP_SQL = f"""
WITH {CTE_CAT}, {CTE_EVENTS}, {CTE_RAIN}, {CTE_ENTITIES}, {cte_grid('label', 'rain')}
SELECT g.municipio_key, g.municipio_name, g.date,
  s.stations_in_municipio, round(s.latitud_raw, 6) AS latitud_raw,
  {RAIN_COLS},
  CAST(coalesce(l.flood_next_24h, 0) AS INTEGER) AS flood_next_24h,
  {sql_calendar('g.date')}
FROM grid g
LEFT JOIN static s ON g.municipio_key = s.municipio_key
LEFT JOIN rain r ON g.municipio_key = r.municipio_key AND g.date = r.date
LEFT JOIN label l ON g.municipio_key = l.municipio_key AND g.date = l.date
"""

query("daily_panel_flagship", FLAGSHIP_SQL)(flagship_panel)
