"""Entity-day aggregations of canonical sources (AGG1-AGG7, JOIN1-JOIN2).

Readings are reduced per (station, day) *before* they meet the station map:
the partial aggregate runs map-side, a station holding a third of all rows
becomes one row per day, and only the reduced table is joined and shuffled
again by (entity, day). Sums, counts and maxima recombine exactly, means as
sum/count, so results equal a single pass over the raw rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from ..functions.dates import day_floor, lenient_timestamp
from ..functions.text import clean_code, contains_any, decimal_comma_double, entity_columns, normalize_text
from ..schema import DATE, FLOOD_EVENT_KEYWORDS, KEY, NAME, STATION
from .filters import clip_dates, keep_matching_or_all, negative_to_null, non_empty_key
from .joins import is_small
from .windows import lag_delta, rolling_sum, shift_days


def _has(df: DataFrame, c: str) -> bool:
    return c in df.columns


def _first_name(name: str = NAME, order: Column | None = None) -> Column:
    """Deterministic 'first' display name: by ``order`` when given, else smallest."""
    if order is None:
        return F.min(F.col(name))
    return F.min_by(F.col(name), order)


def _timed(df: DataFrame, start=None, end=None, time_col: str = "time_raw") -> DataFrame:
    """DAT1 + FLT5 + DAT2 + FLT1: lenient time, drop unparsable, floor to day, clip."""
    t = lenient_timestamp(F.col(time_col), df.schema[time_col].dataType)
    out = df.withColumn("time", t).filter(F.col("time").isNotNull()).withColumn(DATE, day_floor(F.col("time")))
    return clip_dates(out, DATE, start, end)


# ---------------------------------------------------------------------------
# Station catalogue
# ---------------------------------------------------------------------------


def prepare_catalogue(cat: DataFrame, region: str | None = None) -> DataFrame:
    """Clean a canonical station catalogue (STR3, STR4, FLT7, FLT2, STR5).

    Input columns: ``station_code, municipio_raw`` and optionally
    ``departamento_raw, latitud_raw, longitud_raw, altitud_raw``.
    """
    # file order of the catalogue rows ("first" name per entity); taken before
    # any shuffle, so a single file keeps its row order (small dimension only:
    # the id is nondeterministic for the optimizer and stops pushdown above it)
    out = cat.withColumn("_row", F.monotonically_increasing_id())
    out = out.withColumn(STATION, clean_code(F.col(STATION))).withColumns(entity_columns(F.col("municipio_raw")))
    out = non_empty_key(out, KEY)
    if region and _has(out, "departamento_raw"):
        out = keep_matching_or_all(out, normalize_text(F.col("departamento_raw")).contains(region))
    for c in ("latitud_raw", "longitud_raw", "altitud_raw"):
        if _has(out, c):
            dt = out.schema[c].dataType
            out = out.withColumn(c, decimal_comma_double(F.col(c)) if isinstance(dt, StringType) else F.col(c).cast("double"))
    return out


def station_map(catalogue_rows: DataFrame) -> DataFrame:
    """SET3: distinct (station_code, entity key) pairs, empty codes removed.

    The display name is deliberately not part of the map, so that several
    spellings of one entity do not multiply readings (trap T4). Its size is
    checked once here (bounded count); a small map carries a broadcast hint
    into every block join, a large one is joined sort-merge.
    """
    smap = (
        catalogue_rows.select(STATION, KEY)
        .filter(F.col(STATION).isNotNull() & (F.col(STATION) != ""))
        .distinct()
    )
    return F.broadcast(smap) if is_small(smap) else smap


def static_attributes(catalogue_rows: DataFrame, order: Column | None = None) -> DataFrame:
    """AGG1: distinct stations, first name (file order when known), mean
    coordinates per entity."""
    if order is None and _has(catalogue_rows, "_row"):
        order = F.col("_row")
    aggs = [
        F.count_distinct(F.col(STATION)).alias("stations_in_municipio"),
        _first_name(NAME, order).alias(NAME),
    ]
    for c in ("latitud_raw", "longitud_raw", "altitud_raw"):
        if _has(catalogue_rows, c):
            aggs.append(F.avg(F.col(c)).alias(c))
    return catalogue_rows.groupBy(KEY).agg(*aggs)


# ---------------------------------------------------------------------------
# Event log -> label
# ---------------------------------------------------------------------------


def daily_events(
    log: DataFrame,
    keywords: Sequence[str] = FLOOD_EVENT_KEYWORDS,
    region: str | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """AGG2 (+FLT2, DAT1, FLT1, STR4, FLT8): per (entity, day) max flag, flag sum, first name.

    Input columns: ``municipio_raw, event_time_raw, event_type_raw`` and
    optionally ``departamento_raw``. Rows are first reduced per (raw name,
    raw type, day) so that text cleaning runs once per distinct value, not per
    event; the result is the same as cleaning every row.
    """
    work = log
    if region and _has(work, "departamento_raw"):
        work = keep_matching_or_all(work, normalize_text(F.col("departamento_raw")).contains(region))
    work = _timed(work, start, end, time_col="event_time_raw")
    reduced = work.groupBy("municipio_raw", "event_type_raw", DATE).agg(
        F.count(F.lit(1)).alias("__n"), F.min("time").alias("__t")
    )
    reduced = non_empty_key(reduced.withColumns(entity_columns(F.col("municipio_raw"))), KEY)
    reduced = reduced.withColumn("is_flood_event", contains_any(F.col("event_type_raw"), keywords))
    return reduced.groupBy(KEY, DATE).agg(
        F.max("is_flood_event").alias("flood_event_today"),
        F.sum(F.col("is_flood_event") * F.col("__n")).cast("long").alias("flood_events_count_today"),
        _first_name(NAME, F.struct(F.col("__t"), F.col(NAME))).alias(NAME),
    )


def next_day_label(daily: DataFrame, target: str = "flood_next_24h") -> DataFrame:
    """WIN4 + AGG3: the event flag of day d becomes the label of day d-1.

    (entity, day) is unique in ``daily`` and the shift is one-to-one, so the
    reference's re-aggregation by max is the identity and is not planned.
    """
    return daily.select(KEY, shift_days(DATE, -1).alias(DATE), F.col("flood_event_today").alias(target))


def label_names(daily: DataFrame) -> DataFrame:
    """Entity display names seen in the event log, with their first date."""
    return daily.select(KEY, NAME, DATE)


# ---------------------------------------------------------------------------
# Readings -> daily blocks
# ---------------------------------------------------------------------------


def _partials(work: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Raw rows -> per (by, day): row count and per metric sum / count / max."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for m in metrics:
        aggs += [
            F.sum(F.col(m)).alias(f"__s_{m}"),
            F.count(F.col(m)).alias(f"__c_{m}"),
            F.max(F.col(m)).alias(f"__m_{m}"),
        ]
    return work.groupBy(*by, DATE).agg(*aggs)


def _recombine(partial: DataFrame, by: Sequence[str], metrics: Sequence[str], stations: bool) -> DataFrame:
    """Partials -> coarser partials (sums of sums/counts, max of max)."""
    aggs = [F.sum("__n").alias("__n")]
    if stations:
        aggs.append(F.count(F.lit(1)).alias("__st"))
    for m in metrics:
        aggs += [
            F.sum(f"__s_{m}").alias(f"__s_{m}"),
            F.sum(f"__c_{m}").alias(f"__c_{m}"),
            F.max(f"__m_{m}").alias(f"__m_{m}"),
        ]
    return partial.groupBy(*by, DATE).agg(*aggs)


def _entity_day(
    work: DataFrame,
    smap: DataFrame | None,
    metrics: Sequence[str],
) -> DataFrame:
    """Per (entity, day): __n rows, __st stations, and per metric sum/count/max.

    Text codes: raw rows are reduced per (raw code, day) first, codes are
    cleaned on that reduced table and re-reduced per (clean code, day).
    Integer codes are cleaned by a cast, so rows are reduced per (clean code,
    day) at once. Either way a station meets the station map as one row per day.
    """
    if smap is not None and _has(work, "station_code_raw"):
        code_type = work.schema["station_code_raw"].dataType
        if isinstance(code_type, IntegralType):
            # cleaning an integer code is a cast: group by the clean code directly
            coded = work.withColumn(STATION, clean_code(F.col("station_code_raw"), code_type))
            per_station = _partials(coded, [STATION], metrics)
        else:
            raw = _partials(work, ["station_code_raw"], metrics)
            cleaned = raw.withColumn(STATION, clean_code(F.col("station_code_raw"), code_type))
            per_station = _recombine(cleaned, [STATION], metrics, stations=False)
        # JOIN1: inner is the left join followed by dropping null keys;
        # (station, key) is unique in the map, so each row is one station.
        mapped = per_station.join(smap, STATION, "inner")  # size checked in station_map
        return _recombine(mapped, [KEY], metrics, stations=True)
    if _has(work, "municipio_raw"):
        # JOIN2: no station column, entity from the reading's own name;
        # station count is 0 (trap T5).
        raw = _partials(work, ["municipio_raw"], metrics)
        named = non_empty_key(raw.withColumns(entity_columns(F.col("municipio_raw"))), KEY)
        return _recombine(named, [KEY], metrics, stations=False).withColumn("__st", F.lit(0).cast("long"))
    raise ValueError("readings need station_code_raw (with a station map) or municipio_raw")


def _mean(m: str) -> Column:
    return F.try_divide(F.col(f"__s_{m}"), F.col(f"__c_{m}").cast("double"))


def daily_weather(
    readings: DataFrame, smap: DataFrame | None, start=None, end=None, prefix: str = "meteo"
) -> DataFrame:
    """AGG4/AGG5: rows (nulls included), stations, mean and max of temp, rh, wind.

    Input: ``time_raw`` plus any of ``temp_raw, rh_raw, wind_raw`` and
    ``station_code_raw`` or ``municipio_raw``. A metric missing in the source
    gives no column.
    """
    metrics = [m for m in ("temp", "rh", "wind") if _has(readings, f"{m}_raw")]
    if not metrics:
        raise ValueError("weather readings need at least one of temp_raw, rh_raw, wind_raw")
    work = _timed(readings, start, end)
    work = work.withColumns({m: F.col(f"{m}_raw").try_cast("double") for m in metrics})
    day = _entity_day(work, smap, metrics)
    cols = [
        F.col("__n").alias(f"{prefix}_obs_count_24h"),
        F.col("__st").alias(f"{prefix}_station_count_24h"),
    ]
    for m in metrics:
        cols += [_mean(m).alias(f"{prefix}_{m}_mean_24h"), F.col(f"__m_{m}").alias(f"{prefix}_{m}_max_24h")]
    return day.select(KEY, DATE, *cols)


RAIN_SENSOR_PATTERN = "precipit|lluvia"


def daily_rain(
    readings: DataFrame, smap: DataFrame | None, start=None, end=None, frame: str = "rows"
) -> DataFrame:
    """AGG6 + FLT3 + FLT6 + WIN1/WIN2: daily rain sum, max, count, stations,
    and 2- and 3-step rolling sums (rows present by default, trap T7).

    Input: ``time_raw, precip_raw`` plus ``station_code_raw`` or
    ``municipio_raw``, optionally ``sensor_raw``.
    """
    work = readings
    if _has(work, "sensor_raw"):
        work = keep_matching_or_all(work, normalize_text(F.col("sensor_raw")).rlike(RAIN_SENSOR_PATTERN))
    work = _timed(work, start, end)
    work = work.withColumn("precip", negative_to_null(F.col("precip_raw").try_cast("double"))).filter(
        F.col("precip").isNotNull()
    )
    day = _entity_day(work, smap, ["precip"])
    out = day.select(
        KEY,
        DATE,
        F.col("__s_precip").alias("precip_mm_24h_sum"),
        F.col("__m_precip").alias("precip_mm_24h_max"),
        F.col("__n").alias("precip_obs_count_24h"),
        F.col("__st").alias("precip_station_count_24h"),
    )
    return out.withColumns(
        {
            "precip_mm_48h_sum": rolling_sum("precip_mm_24h_sum", 2, frame=frame),
            "precip_mm_72h_sum": rolling_sum("precip_mm_24h_sum", 3, frame=frame),
        }
    )


def daily_level(
    readings: DataFrame, smap: DataFrame, start=None, end=None, part_col: str | None = "_part"
) -> DataFrame:
    """AGG7 + FLT4 + WIN3: daily level mean, max, stations and day-on-day delta.

    Input: ``station_code_raw, time_raw, level_raw``, optionally ``param_raw``
    (level parameters kept per part when any exist) and a part column.
    """
    work = readings
    if _has(work, "param_raw"):
        by = [part_col] if part_col and _has(work, part_col) else None
        work = keep_matching_or_all(work, normalize_text(F.col("param_raw")).contains("nivel"), by, ["param_raw"])
    work = _timed(work, start, end)
    work = work.withColumn("level", F.col("level_raw").try_cast("double")).filter(F.col("level").isNotNull())
    day = _entity_day(work, smap, ["level"])
    out = day.select(
        KEY,
        DATE,
        _mean("level").alias("river_level_mean_24h"),
        F.col("__m_level").alias("river_level_max_24h"),
        F.col("__st").alias("river_level_station_count_24h"),
    )
    return out.withColumn("river_level_delta_24h", lag_delta("river_level_mean_24h"))


def readings_to_entity(readings: DataFrame, smap: DataFrame, code_col: str = "station_code_raw") -> DataFrame:
    """JOIN1 at row level: each reading with its cleaned station code and the
    entity key(s) of that station (left join; unmatched rows keep a null key)."""
    code_type = readings.schema[code_col].dataType
    return readings.withColumn(STATION, clean_code(F.col(code_col), code_type)).join(smap, STATION, "left")
