"""Helpers shared by the training-data operators.

``spilled`` writes a step once as Parquet under the cluster's shared checkpoint
folder, so that later steps re-read it column by column and a lost executor
costs no recomputation; ``join_by_size`` broadcasts a side only after its bytes
were counted.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: ``[\x20\x09-\x0D]``, the white space that separates words, as characters
#: and as a regular-expression class body.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spilled(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder (in the session's Parquet codec or
    ``codec``) and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def aside(df: DataFrame, names) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with the columns that bear one of ``names`` (an operator's own) renamed, and
    a function that gives them their names back, in any frame that still has them."""
    taken = {n.lower() for n in names}
    mark = "kept_aside"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark = "_" + mark
    moved = {c: f"{mark}_{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    back = lambda out: out.withColumnsRenamed({new: old for old, new in moved.items()})
    return df.withColumnsRenamed(moved), back


def join_by_size(left: DataFrame, small: DataFrame, key: str, how: str = "inner", max_bytes: int = 8 << 20) -> DataFrame:
    """Join ``small`` (a materialized frame of fixed-width and string columns) on ``key``.

    Its bytes are summed first: up to ``max_bytes`` it is broadcast, beyond that
    the join is an ordinary shuffled equi-join whose hot keys AQE splits.
    """
    widths = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16 if f.dataType.typeName() in ("string", "binary") else F.coalesce(F.size(F.col(f.name)) * 8, F.lit(0)) + 16 if f.dataType.typeName() == "array" else F.lit(8)
        for f in small.schema.fields
    ]
    total = small.agg(F.sum(sum(widths, F.lit(0)))).first()[0] or 0
    return left.join(F.broadcast(small) if total <= max_bytes else small, key, how)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null text: none)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ranges(n: Column) -> Column:
    """``[0, 1, ..., n-1]``; empty for ``n`` <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (avalanche)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_BASE = np.uint64(0xA0761D6478BD642F)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True
_SPACE_RE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes that are hashed at a time.
BLOCK_BYTES = 1 << 16


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class RunHasher:
    """Hashes of runs [start, end) of an integer sequence from prefix sums of a
    polynomial modulo 2^64; powers are kept between calls."""

    def __init__(self, base: np.uint64):
        self.base, self.up, self.down = base, powers(base, 0), powers(base, 0)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(values):
            self.up = powers(self.base, 2 * len(values) + 1)
            self.down = powers(np.uint64(pow(int(self.base), -1, 1 << 64)), 2 * len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], dtype=np.uint64, out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


_bytes_hasher = RunHasher(_BYTE_BASE)
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the len(texts) + 1 bounds between
    the texts' words. Works on about ``BLOCK_BYTES`` at a time (a longer word is one block)."""
    blob = b"\n".join(texts) + b"\n"
    hashes, starts, at = [], [], 0
    while at < len(blob):
        end = at + BLOCK_BYTES
        if end < len(blob):
            gap = _SPACE_RE.search(blob, end)
            end = gap.end() if gap else len(blob)
        data = np.frombuffer(blob, np.uint8, min(end, len(blob)) - at, at)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _IS_SPACE[data]])))
        first, last = edge[0::2], edge[1::2]
        hashes.append(_bytes_hasher.of(_bytes_hasher.prefix(_BYTE_VALUE[data]), first, last))
        starts.append(first + at)
        at += len(data)
    ends_of_texts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), ends_of_texts)


def rows_of(batch, *names: str, step: int = 512):
    """Rows of an Arrow record batch as tuples, decoded ``step`` rows at a time."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(*(part.column(n).to_pylist() for n in names))
