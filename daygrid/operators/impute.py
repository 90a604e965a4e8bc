"""Missing flags and three-level median imputation (IMP1-IMP3, WIN5)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..schema import CALENDAR_COLUMNS, KEY, NON_FEATURES, TARGET
from ..session import cut_lineage
from .joins import join_small
from .stats import exact_medians


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (TARGET,)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def missing_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IMP1: ``<c>_missing`` = 1 when ``c`` is null, for every listed column."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in cols})


def impute_three_level(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    key: str = KEY,
    flags: bool = True,
    never_null: Sequence[str] = CALENDAR_COLUMNS,
    materialize: bool = True,
) -> DataFrame:
    """IMP1 + IMP2: flag, then fill by entity median, then by the column median
    after that fill, then by 0.0.

    Entity medians are one grouped aggregate for all columns (a group holds at
    most one row per day on the panel) joined back on the key; the global
    medians are exact and distributed (``exact_medians``). Columns listed in
    ``never_null`` (calendar) get flags but keep their integer type.
    """
    if cols is None:
        cols = numeric_columns(df)
    cols = list(cols)
    # The panel feeds the entity medians, the join back, two median passes and
    # the result: write it once to the shared checkpoint folder.
    if materialize:
        df = cut_lineage(df)
    out = missing_flags(df, cols) if flags else df
    fill = [c for c in cols if c not in never_null]
    if not fill:
        return out
    group_med = df.groupBy(key).agg(*[F.median(F.col(c)).alias(f"__g_{c}") for c in fill])
    stepped = join_small(out, group_med, key, "left", materialize=materialize).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"__g_{c}")) for c in fill}
    ).drop(*[f"__g_{c}" for c in fill])
    med = exact_medians(stepped, fill)
    return stepped.withColumns(
        {c: F.coalesce(F.col(c), F.lit(med[c]).cast("double"), F.lit(0.0)) for c in fill}
    )


def feature_columns(df: DataFrame, excluded: Sequence[str] = NON_FEATURES) -> list[str]:
    """IMP3: every column except key, name, date and label."""
    return [c for c in df.columns if c not in excluded]
