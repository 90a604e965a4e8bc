"""Size-checked broadcast joins.

A side is broadcast only if its rows, at the width of its schema, stay below a
bound in bytes. They are counted with a bounded job that stops one row beyond;
beyond the bound the join is left to the planner (sort-merge with AQE skew
splitting). This keeps a large side from being shuffled just to meet a small
dimension, without trusting file-size estimates.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

MAX_BROADCAST_BYTES = 32 << 20
CONF_KEY = "daygrid.broadcast.maxBytes"
#: Bytes counted for a text, binary or nested column of a row.
WIDE_COLUMN = 64


def broadcast_bound(df: DataFrame) -> int:
    """Rows of ``df``'s width that fit the bound in bytes."""
    limit = int(df.sparkSession.conf.get(CONF_KEY, str(MAX_BROADCAST_BYTES)))
    width = 16 + sum(8 if isinstance(f.dataType, (NumericType, BooleanType, DatetimeType)) else WIDE_COLUMN for f in df.schema.fields)
    return max(limit // width, 1)


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (bounded counting job)."""
    bound = broadcast_bound(df) if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    max_rows: int | None = None,
    materialize: bool = False,
) -> DataFrame:
    """``big`` joined with ``small``; ``small`` is broadcast only when its
    counted size is within the bound. ``materialize`` writes ``small`` to the
    checkpoint folder first, so an expensive small side is computed once for
    the count and the join."""
    if materialize:
        from ..session import cut_lineage

        small = cut_lineage(small)
    keys = [on] if isinstance(on, str) else list(on)
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), keys, how)
    return big.join(small, keys, how)


def join_bounded(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Broadcast join for a side whose size is bounded by construction (one row
    per shuffle partition, per fixed rule, per column...), no counting job."""
    keys = [on] if isinstance(on, str) else list(on)
    return big.join(F.broadcast(small), keys, how)
