"""Entity-day panel assembly (JOIN3-JOIN8, NUM2, DAT3, TOP1).

Plan shape: one small aggregate per source on (entity, day), the entity table
(names + static attributes, one row per entity) exploded into the day grid
without a join, then a chain of left joins on (entity, day). All joins share
the same hash partitioning on (entity, day), so the grid is exchanged once
and every block once; AQE turns a join into a broadcast only after measuring
the block.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..schema import CALENDAR_COLUMNS, DATE, FLOOD_EVENT_KEYWORDS, KEY, NAME, TARGET
from ..session import cut_all
from . import aggregates as A
from .grid import calendar_grid, date_bounds, entity_reference
from .impute import impute_three_level, numeric_columns
from .joins import join_small


@dataclass(frozen=True)
class PanelOptions:
    region: str | None = None
    keywords: Sequence[str] = FLOOD_EVENT_KEYWORDS
    start: object = None
    end: object = None
    static_on: Sequence[str] = (KEY,)  # (KEY, NAME) reproduces the name-sensitive join (T2)
    frame: str = "rows"  # rolling sums over rows present (reference) or calendar days
    impute: bool = True
    calendar: bool = True


def attach(panel: DataFrame, block: DataFrame | None, on: Sequence[str] = (KEY, DATE)) -> DataFrame:
    """JOIN7/JOIN8: left join of an optional block on (entity, day)."""
    if block is None:
        return panel
    return panel.join(block, list(on), "left")


def fill_label(panel: DataFrame, target: str = TARGET) -> DataFrame:
    """NUM2 / T9: absent label = 0, integer typed."""
    return panel.withColumn(target, F.coalesce(F.col(target), F.lit(0)).cast("int"))


def add_calendar(panel: DataFrame, date_col: str = DATE) -> DataFrame:
    """DAT3."""
    return panel.withColumns(calendar_columns(date_col))


def assemble(
    entities: DataFrame,
    static: DataFrame | None,
    bounds: DataFrame,
    blocks: Sequence[DataFrame | None],
    label: DataFrame | None,
    static_on: Sequence[str] = (KEY,),
    target: str = TARGET,
    calendar: bool = True,
) -> DataFrame:
    """Grid + static + blocks + label (+ calendar)."""
    ent = entities
    if static is not None:
        s = static if NAME in static_on else static.drop(NAME)
        ent = join_small(ent, s, list(static_on), "left")  # JOIN6, on entities, before the explode
    panel = calendar_grid(ent, bounds)
    for b in blocks:
        panel = attach(panel, b)
    if label is not None:
        panel = fill_label(attach(panel, label.select(KEY, DATE, target)), target)
    if calendar:
        panel = add_calendar(panel)
    return panel


def build_panel(
    catalogue: DataFrame,
    events_log: DataFrame,
    weather: DataFrame | None = None,
    rain: DataFrame | None = None,
    level: DataFrame | None = None,
    options: PanelOptions = PanelOptions(),
) -> DataFrame:
    """The whole entity-day build from canonical sources (see ``sources.canonical``).

    Each source is read once: its daily block (a row per entity and day) is written to
    the shared folder, and names, day bounds and joins read that."""
    o = options
    cat = A.prepare_catalogue(catalogue, o.region)
    smap = A.station_map(cat)
    static = A.static_attributes(cat)
    daily, *blocks = cut_all(
        A.daily_events(events_log, o.keywords, o.region, o.start, o.end),
        None if weather is None else A.daily_weather(weather, smap, o.start, o.end),
        None if rain is None else A.daily_rain(rain, smap, o.start, o.end, frame=o.frame),
        None if level is None else A.daily_level(level, smap, o.start, o.end),
    )
    blocks = [b for b in blocks if b is not None]
    label = A.next_day_label(daily)
    entities = entity_reference(A.label_names(daily), cat.select(KEY, NAME, "_row"))
    bounds = date_bounds([label, *blocks], o.start, o.end)
    panel = assemble(entities, static, bounds, blocks, label, o.static_on, calendar=o.calendar)
    if o.impute:
        panel = impute_three_level(panel, numeric_columns(panel), never_null=CALENDAR_COLUMNS)
    return panel


def sort_panel(panel: DataFrame) -> DataFrame:
    """TOP1: final (entity, day) order (range-partitioned sort)."""
    return panel.orderBy(KEY, DATE)
