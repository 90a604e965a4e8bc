"""Registered queries for the individual panel operators (sources -> daily
blocks -> grid -> joins -> flags and imputation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.grid import calendar_grid, date_bounds, entity_reference
from ..operators.impute import feature_columns, impute_three_level, missing_flags, numeric_columns
from ..operators.panel import assemble, fill_label
from ..operators.windows import rolling_sum
from ..schema import CALENDAR_COLUMNS, DATE, KEY, NAME, TARGET
from ..session import cut_all
from ..sources import canonical as C
from . import analogues as S
from .panel_queries import CTE_CAT, CTE_ENTITIES, CTE_EVENTS, CTE_RAIN, cte_grid
from .registry import query, sql_calendar, sql_clean_code, sql_norm_key, sql_strip

# ---------------------------------------------------------------------------
# SQL building blocks for the weather and level blocks
# ---------------------------------------------------------------------------

CTE_WEATHER = f"""
wr AS (
  SELECT {sql_clean_code('l_suppkey')} AS station_code, CAST(l_shipdate AS DATE) AS date,
         CAST(l_extendedprice AS DOUBLE) AS temp, CAST(l_discount AS DOUBLE) AS rh, CAST(l_tax AS DOUBLE) AS wind
  FROM lineitem WHERE l_shipdate IS NOT NULL
),
weather AS (
  SELECT m.municipio_key, wr.date, count(*) AS meteo_obs_count_24h, count(DISTINCT wr.station_code) AS meteo_station_count_24h,
         avg(temp) AS meteo_temp_mean_24h, max(temp) AS meteo_temp_max_24h,
         avg(rh) AS meteo_rh_mean_24h, max(rh) AS meteo_rh_max_24h,
         avg(wind) AS meteo_wind_mean_24h, max(wind) AS meteo_wind_max_24h
  FROM wr JOIN smap m ON wr.station_code = m.station_code GROUP BY m.municipio_key, wr.date
)"""

CTE_LEVEL = f"""
lr0 AS (
  SELECT {sql_clean_code('l_suppkey')} AS station_code, CAST(l_shipdate AS DATE) AS date, CAST(l_tax AS DOUBLE) AS level,
         l_returnflag AS part,
         contains(lower(strip_accents(CASE WHEN l_linestatus = 'O' THEN 'NIVEL' ELSE 'CAUDAL' END)), 'nivel') AS m
  FROM lineitem
),
lp AS (SELECT part, bool_or(m) AS any_m FROM lr0 GROUP BY part),
lr AS (SELECT lr0.* FROM lr0 JOIN lp ON lr0.part = lp.part WHERE (lr0.m OR NOT lp.any_m) AND lr0.date IS NOT NULL AND lr0.level IS NOT NULL),
lday AS (
  SELECT m.municipio_key, lr.date, avg(level) AS river_level_mean_24h, max(level) AS river_level_max_24h,
         count(DISTINCT lr.station_code) AS river_level_station_count_24h
  FROM lr JOIN smap m ON lr.station_code = m.station_code GROUP BY m.municipio_key, lr.date
),
level AS (
  SELECT *, river_level_mean_24h - lag(river_level_mean_24h) OVER (PARTITION BY municipio_key ORDER BY date) AS river_level_delta_24h
  FROM lday
)"""

WEATHER_COLS = [
    "meteo_obs_count_24h", "meteo_station_count_24h", "meteo_temp_mean_24h", "meteo_temp_max_24h",
    "meteo_rh_mean_24h", "meteo_rh_max_24h", "meteo_wind_mean_24h", "meteo_wind_max_24h",
]
LEVEL_COLS = ["river_level_mean_24h", "river_level_max_24h", "river_level_station_count_24h", "river_level_delta_24h"]
RAIN_NAMES = [
    "precip_mm_24h_sum", "precip_mm_24h_max", "precip_obs_count_24h", "precip_station_count_24h",
    "precip_mm_48h_sum", "precip_mm_72h_sum",
]
COUNT_COLS = {
    "meteo_obs_count_24h", "meteo_station_count_24h", "precip_obs_count_24h",
    "precip_station_count_24h", "river_level_station_count_24h", "stations_in_municipio",
}


def _r(c: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (DuckDB's avg can land just below 0)
    return c if c in COUNT_COLS else f"round({c}, 6) + 0.0 AS {c}"


# ---------------------------------------------------------------------------
# Spark building blocks
# ---------------------------------------------------------------------------


def _base(spark, d):
    cat = A.prepare_catalogue(S.catalogue(spark, d))
    smap = A.station_map(cat)
    daily = A.daily_events(S.event_log(spark, d), S.URGENT)
    return cat, smap, daily


def full_panel(spark: SparkSession, d: str) -> DataFrame:
    """Grid with static, weather, rain, level blocks, label and calendar (no imputation)."""
    cat, smap, daily = _base(spark, d)
    weather = A.daily_weather(S.weather_readings(spark, d), smap)
    rain = A.daily_rain(S.rain_readings(spark, d), smap)
    level = A.daily_level(S.level_readings(spark, d), smap)
    daily, weather, rain, level = cut_all(daily, weather, rain, level)  # bounds, names and joins read these
    label = A.next_day_label(daily)
    entities = entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))
    bounds = date_bounds([label, weather, rain, level])
    return assemble(entities, A.static_attributes(cat), bounds, [weather, rain, level], label)


PANEL_NUMERIC = ["stations_in_municipio", "latitud_raw", *WEATHER_COLS, *RAIN_NAMES, *LEVEL_COLS, *CALENDAR_COLUMNS]
FILL_COLS = [c for c in PANEL_NUMERIC if c not in CALENDAR_COLUMNS]

CTE_PANEL = f"""
{CTE_CAT}, {CTE_EVENTS}, {CTE_RAIN}, {CTE_WEATHER}, {CTE_LEVEL}, {CTE_ENTITIES}, {cte_grid('label', 'weather', 'rain', 'level')},
panel AS (
  SELECT g.municipio_key, g.municipio_name, g.date,
    s.stations_in_municipio, s.latitud_raw,
    {', '.join('w.' + c for c in WEATHER_COLS)},
    {', '.join('r.' + c for c in RAIN_NAMES)},
    {', '.join('v.' + c for c in LEVEL_COLS)},
    CAST(coalesce(l.flood_next_24h, 0) AS INTEGER) AS flood_next_24h,
    {sql_calendar('g.date')}
  FROM grid g
  LEFT JOIN static s ON g.municipio_key = s.municipio_key
  LEFT JOIN weather w ON g.municipio_key = w.municipio_key AND g.date = w.date
  LEFT JOIN rain r ON g.municipio_key = r.municipio_key AND g.date = r.date
  LEFT JOIN level v ON g.municipio_key = v.municipio_key AND g.date = v.date
  LEFT JOIN label l ON g.municipio_key = l.municipio_key AND g.date = l.date
)"""

CTE_IMPUTED = f"""{CTE_PANEL},
gm AS (SELECT municipio_key, {', '.join(f'median({c}) AS g_{c}' for c in FILL_COLS)} FROM panel GROUP BY municipio_key),
f1 AS (
  SELECT p.*, {', '.join(f'coalesce(CAST(p.{c} AS DOUBLE), gm.g_{c}) AS f_{c}' for c in FILL_COLS)}
  FROM panel p LEFT JOIN gm ON p.municipio_key = gm.municipio_key
),
mm AS (SELECT {', '.join(f'median(f_{c}) AS m_{c}' for c in FILL_COLS)} FROM f1),
imputed AS (
  SELECT municipio_key, municipio_name, date, flood_next_24h, {', '.join(CALENDAR_COLUMNS)},
    {', '.join(f'coalesce(f_{c}, m_{c}, 0.0) AS {c}' for c in FILL_COLS)},
    {', '.join(f'CAST({c} IS NULL AS INTEGER) AS {c}_missing' for c in PANEL_NUMERIC)}
  FROM f1 CROSS JOIN mm
)"""


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


@query(
    "reading_to_entity",
    f"""
WITH {CTE_CAT}
SELECT l.l_orderkey, l.l_linenumber, {sql_clean_code('l.l_suppkey')} AS station_code, m.municipio_key
FROM lineitem l LEFT JOIN smap m ON {sql_clean_code('l.l_suppkey')} = m.station_code
""",
)
def reading_to_entity(spark: SparkSession, d: str) -> DataFrame:
    """JOIN1: every reading with the entity of its station."""
    _, smap, _ = _base(spark, d)
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("station_code_raw"))
    return A.readings_to_entity(li, smap).select("l_orderkey", "l_linenumber", "station_code", KEY)


@query(
    "static_attributes",
    f"""
WITH {CTE_CAT}
SELECT municipio_key, count(DISTINCT station_code) AS stations_in_municipio, min(municipio_name) AS municipio_name,
       round(avg(latitud_raw), 6) AS latitud_raw
FROM cat GROUP BY municipio_key
""",
)
def static_attributes(spark: SparkSession, d: str) -> DataFrame:
    """AGG1: distinct stations, first name, mean coordinate per entity."""
    cat, _, _ = _base(spark, d)
    return A.static_attributes(cat)


@query(
    "daily_events",
    f"""
WITH {CTE_EVENTS}
SELECT municipio_key, date, flood_event_today, flood_events_count_today, municipio_name FROM daily
""",
)
def daily_events(spark: SparkSession, d: str) -> DataFrame:
    """AGG2: per entity and day, any keyword event, number of events, name."""
    return _base(spark, d)[2]


@query(
    "next_day_label",
    f"""
WITH {CTE_EVENTS}
SELECT municipio_key, date, flood_next_24h FROM label
""",
)
def next_day_label(spark: SparkSession, d: str) -> DataFrame:
    """WIN4 + AGG3: tomorrow's event flag as today's label."""
    return A.next_day_label(_base(spark, d)[2])


@query(
    "daily_weather",
    f"""
WITH {CTE_CAT}, {CTE_WEATHER}
SELECT municipio_key, date, {', '.join(_r(c) for c in WEATHER_COLS)} FROM weather
""",
)
def daily_weather(spark: SparkSession, d: str) -> DataFrame:
    """AGG4/AGG5: daily rows, stations, mean and max of three metrics."""
    _, smap, _ = _base(spark, d)
    return A.daily_weather(S.weather_readings(spark, d), smap)


@query(
    "daily_rain",
    f"""
WITH {CTE_CAT}, {CTE_RAIN}
SELECT municipio_key, date, {', '.join(_r(c) for c in RAIN_NAMES)} FROM rain
""",
)
def daily_rain(spark: SparkSession, d: str) -> DataFrame:
    """AGG6 + FLT6 + WIN1/WIN2: daily rain with 2- and 3-row sums."""
    _, smap, _ = _base(spark, d)
    return A.daily_rain(S.rain_readings(spark, d), smap)


@query(
    "daily_level_delta",
    f"""
WITH {CTE_CAT}, {CTE_LEVEL}
SELECT municipio_key, date, {', '.join(_r(c) for c in LEVEL_COLS)} FROM level
""",
)
def daily_level_delta(spark: SparkSession, d: str) -> DataFrame:
    """AGG7 + FLT4 + WIN3: level parameter kept per part when present, daily
    mean/max/stations and the day-on-day delta of the mean."""
    _, smap, _ = _base(spark, d)
    return A.daily_level(S.level_readings(spark, d), smap)


def _user_daily(spark, d):
    e = S.table(spark, d, "events")
    return e.groupBy(F.col("user_id"), F.to_date("ts").alias(DATE)).agg(F.sum("value").alias("v"))


_SQL_USER_DAILY = "ud AS (SELECT user_id, CAST(ts AS DATE) AS date, sum(value) AS v FROM events GROUP BY user_id, CAST(ts AS DATE))"


@query(
    "rolling_rows_2_3",
    f"""
WITH {_SQL_USER_DAILY}
SELECT user_id, date, round(v, 6) AS v,
  round(sum(v) OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), 6) AS v_2,
  round(sum(v) OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS v_3
FROM ud
""",
)
def rolling_rows_2_3(spark: SparkSession, d: str) -> DataFrame:
    """WIN1/WIN2: sums over the last 2 and 3 rows present per user (gaps ignored)."""
    ud = _user_daily(spark, d)
    return ud.withColumns(
        {"v_2": rolling_sum("v", 2, key="user_id", frame="rows"), "v_3": rolling_sum("v", 3, key="user_id", frame="rows")}
    )


@query(
    "rolling_days_2_3",
    f"""
WITH {_SQL_USER_DAILY}
SELECT user_id, date, round(v, 6) AS v,
  round(sum(v) OVER (PARTITION BY user_id ORDER BY date RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW), 6) AS v_2,
  round(sum(v) OVER (PARTITION BY user_id ORDER BY date RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW), 6) AS v_3
FROM ud
""",
)
def rolling_days_2_3(spark: SparkSession, d: str) -> DataFrame:
    """T7 option: sums over the last 2 and 3 calendar days per user."""
    ud = _user_daily(spark, d)
    return ud.withColumns(
        {"v_2": rolling_sum("v", 2, key="user_id", frame="days"), "v_3": rolling_sum("v", 3, key="user_id", frame="days")}
    )


@query(
    "entity_reference_union",
    f"""
WITH {CTE_CAT}, {CTE_EVENTS}, {CTE_ENTITIES}
SELECT municipio_key, municipio_name FROM ents
""",
)
def entity_reference_union(spark: SparkSession, d: str) -> DataFrame:
    """SET1/SET4: names from the event log first, then the catalogue, one per key."""
    cat, _, daily = _base(spark, d)
    return entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))


@query(
    "date_bounds",
    f"""
WITH {CTE_CAT}, {CTE_EVENTS}, {CTE_RAIN},
b AS (SELECT min(lo) AS lo, max(hi) AS hi FROM (SELECT min(date) AS lo, max(date) AS hi FROM label UNION ALL SELECT min(date), max(date) FROM rain))
SELECT 'sources' AS bounds, lo, hi FROM b
UNION ALL
SELECT 'clipped', greatest(lo, DATE '1996-06-01'), least(hi, DATE '2000-12-31') FROM b
""",
)
def date_bounds_q(spark: SparkSession, d: str) -> DataFrame:
    """AGG8: day range over the label and rain sources, and tightened by user bounds."""
    _, smap, daily = _base(spark, d)
    label = A.next_day_label(daily)
    rain = A.daily_rain(S.rain_readings(spark, d), smap)
    a = date_bounds([label, rain]).select(F.lit("sources").alias("bounds"), "lo", "hi")
    b = date_bounds([label, rain], "1996-06-01", "2000-12-31").select(F.lit("clipped").alias("bounds"), "lo", "hi")
    return a.unionByName(b)


@query(
    "calendar_grid",
    f"""
WITH {CTE_CAT}, {CTE_EVENTS}, {CTE_RAIN}, {CTE_ENTITIES}, {cte_grid('label', 'rain')}
SELECT municipio_key, municipio_name, date FROM grid
""",
)
def calendar_grid_q(spark: SparkSession, d: str) -> DataFrame:
    """JOIN4/JOIN5 + DAT4: every entity on every day of the source range."""
    cat, smap, daily = _base(spark, d)
    label = A.next_day_label(daily)
    rain = A.daily_rain(S.rain_readings(spark, d), smap)
    entities = entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))
    return calendar_grid(entities, date_bounds([label, rain]))


@query(
    "fill_and_cast",
    f"""
WITH {CTE_CAT}, {CTE_EVENTS}, {CTE_RAIN}, {CTE_ENTITIES}, {cte_grid('label', 'rain')}
SELECT g.municipio_key, g.date, CAST(coalesce(l.flood_next_24h, 0) AS INTEGER) AS flood_next_24h
FROM grid g LEFT JOIN label l ON g.municipio_key = l.municipio_key AND g.date = l.date
""",
)
def fill_and_cast(spark: SparkSession, d: str) -> DataFrame:
    """NUM2 + JOIN8: label joined to the grid, absent = 0, integer."""
    cat, smap, daily = _base(spark, d)
    label = A.next_day_label(daily)
    rain = A.daily_rain(S.rain_readings(spark, d), smap)
    entities = entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))
    grid = calendar_grid(entities, date_bounds([label, rain]))
    return fill_label(grid.join(label, [KEY, DATE], "left")).select(KEY, DATE, TARGET)


@query(
    "panel_join",
    f"""
WITH {CTE_PANEL}
SELECT municipio_key, municipio_name, date, stations_in_municipio, round(latitud_raw, 6) AS latitud_raw,
  {', '.join(_r(c) for c in WEATHER_COLS + RAIN_NAMES + LEVEL_COLS)},
  flood_next_24h, {', '.join(CALENDAR_COLUMNS)}
FROM panel
""",
)
def panel_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN6-JOIN8: grid with static, weather, rain and level blocks and the label."""
    return full_panel(spark, d)


@query(
    "missing_flags",
    f"""
WITH {CTE_PANEL}
SELECT municipio_key, date, {', '.join(f'CAST({c} IS NULL AS INTEGER) AS {c}_missing' for c in PANEL_NUMERIC)} FROM panel
""",
)
def missing_flags_q(spark: SparkSession, d: str) -> DataFrame:
    """IMP1: a missing flag for every numeric panel column (calendar included)."""
    p = full_panel(spark, d)
    cols = numeric_columns(p)
    return missing_flags(p, cols).select(KEY, DATE, *[f"{c}_missing" for c in cols])


@query(
    "impute_three_level",
    f"""
WITH {CTE_IMPUTED}
SELECT municipio_key, municipio_name, date, flood_next_24h, {', '.join(CALENDAR_COLUMNS)},
  {', '.join(_r(c) for c in FILL_COLS)},
  {', '.join(f'{c}_missing' for c in PANEL_NUMERIC)}
FROM imputed
""",
)
def impute_three_level_q(spark: SparkSession, d: str) -> DataFrame:
    """IMP1 + IMP2 + WIN5: flags, entity median, column median, then 0."""
    p = full_panel(spark, d)
    return impute_three_level(p, numeric_columns(p))


@query(
    "run_metadata",
    f"""
WITH {CTE_IMPUTED}
SELECT count(*) AS rows, count(DISTINCT municipio_key) AS n_municipios, min(date) AS date_min, max(date) AS date_max,
  {len(PANEL_NUMERIC) * 2} AS feature_count
FROM imputed
""",
)
def run_metadata(spark: SparkSession, d: str) -> DataFrame:
    """AGG9 + IMP3: rows, entities, date range and number of features of the built panel."""
    p = impute_three_level(full_panel(spark, d))
    feats = feature_columns(p)
    return p.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(KEY).alias("n_municipios"),
        F.min(DATE).alias("date_min"),
        F.max(DATE).alias("date_max"),
    ).withColumn("feature_count", F.lit(len(feats)))


FEATURES = [*PANEL_NUMERIC, *[f"{c}_missing" for c in PANEL_NUMERIC]]


@query(
    "feature_list",
    f"""
WITH {CTE_IMPUTED}
{' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS non_null FROM imputed" for c in FEATURES)}
""",
)
def feature_list(spark: SparkSession, d: str) -> DataFrame:
    """IMP3: every feature of the built panel (all columns but key, name, date,
    label) with its non-null count, in one aggregate."""
    p = impute_three_level(full_panel(spark, d))
    feats = feature_columns(p)
    counts = p.agg(*[F.count(F.col(c)).alias(c) for c in feats])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null")) for c in feats]))
    )


@query(
    "name_fallback_mapping",
    f"""
WITH r AS (
  SELECT {sql_strip('n.n_name')} AS municipio_name, {sql_norm_key(sql_strip('n.n_name'))} AS municipio_key,
         CAST(o.o_orderdate AS DATE) AS date, CAST(o.o_totalprice AS DOUBLE) AS temp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderdate IS NOT NULL
)
SELECT municipio_key, date, count(*) AS meteo_obs_count_24h, CAST(0 AS BIGINT) AS meteo_station_count_24h,
       round(avg(temp), 6) AS meteo_temp_mean_24h, round(max(temp), 6) AS meteo_temp_max_24h
FROM r WHERE municipio_key <> '' GROUP BY municipio_key, date
""",
)
def name_fallback_mapping(spark: SparkSession, d: str) -> DataFrame:
    """JOIN2 + T5: readings without a station column keyed by their own
    municipality text; station count is 0."""
    o, c, n = S.table(spark, d, "orders"), S.table(spark, d, "customer"), S.table(spark, d, "nation")
    readings = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("o_orderdate").alias("time_raw"), F.col("o_totalprice").alias("temp_raw"), F.col("n_name").alias("municipio_raw")
    )
    return A.daily_weather(readings, None)


_MESSY = {
    "l_shipdate": "Fecha Observación",
    "l_quantity": "Valor Observado",
    "l_suppkey": "Código Estación",
    "l_tax": "VALOR",
    "l_linestatus": "Descripción Sensor",
    "l_returnflag": "Fecha de carga (texto)",
}


@query(
    "canonical_columns",
    """
SELECT l_shipdate AS time_raw, l_quantity AS precip_raw, l_suppkey AS station_code_raw, l_linestatus AS sensor_raw
FROM lineitem
""",
)
def canonical_columns(spark: SparkSession, d: str) -> DataFrame:
    """PRJ1-PRJ5: a rain source with loose headers resolved to canonical names
    (the 'valor observado' column wins over the plain 'valor' one)."""
    li = S.table(spark, d, "lineitem")
    messy = li.select(*[F.col(k).alias(v) for k, v in _MESSY.items()])
    return C.canonicalize(messy, C.RAIN)
