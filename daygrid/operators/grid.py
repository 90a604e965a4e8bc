"""Entity reference, date bounds and the dense entity x day grid (SET1, AGG8, JOIN4/5, DAT4)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_sequence
from ..schema import DATE, KEY, NAME
from .filters import _as_date


def entity_reference(*sources: DataFrame) -> DataFrame:
    """SET1/SET4: one display name per entity key.

    ``sources`` are (key, name[, date][, _row]) frames in priority order; the
    name of the highest-priority source wins, within a source the earliest
    date, then the first row (file order), then the smallest name. One small
    aggregate over entities, no window.
    """
    parts = []
    for prio, src in enumerate(sources):
        order_date = F.col(DATE) if DATE in src.columns else F.lit(None).cast("date")
        order_row = F.col("_row") if "_row" in src.columns else F.lit(None).cast("long")
        parts.append(
            src.select(
                F.col(KEY),
                F.col(NAME),
                F.struct(F.lit(prio).alias("p"), order_date.alias("d"), order_row.alias("r"), F.col(NAME).alias("n")).alias("__o"),
            )
        )
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return union.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min_by(F.col(NAME), F.col("__o")).alias(NAME))


def date_bounds(sources: Sequence[DataFrame], start=None, end=None, date_col: str = DATE) -> DataFrame:
    """AGG8: one row (lo, hi) = min/max day over all sources, tightened by the bounds."""
    partial = [s.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")) for s in sources]
    both = reduce(lambda a, b: a.unionByName(b), partial).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    if start is not None:
        lo = F.greatest(lo, _as_date(start))
    if end is not None:
        hi = F.least(hi, _as_date(end))
    return both.select(lo.alias("lo"), hi.alias("hi"))


def calendar_grid(entities: DataFrame, bounds: DataFrame) -> DataFrame:
    """JOIN4/JOIN5: every entity row repeated for each day in [lo, hi].

    The bounds enter as scalar subqueries and the days are generated per
    entity row, so no cross join and no shuffle; entity attributes already on
    ``entities`` (names, static features) are carried along.
    """
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    return entities.select(*entities.columns, day_sequence(lo, hi).alias(DATE))
