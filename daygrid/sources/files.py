"""File discovery and choice (SRC1-SRC4).

The file table is a DataFrame listed by tasks (``storage.list_tree``), so listing,
scoring and picking are Spark jobs whose only driver-side result is the chosen
path.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import keyword_score, normalize_text, folded
from .storage import list_tree

TABLE_SUFFIXES = (".csv", ".txt", ".xlsx", ".xls", ".parquet")
DELIMITERS = (",", ";", "\t", "|")


def list_files(spark: SparkSession, root: str, suffixes: Sequence[str] | None = TABLE_SUFFIXES, errors: bool = False) -> DataFrame:
    """SRC1: recursive listing ``(path, relative_path, file_name, size_bytes,
    modification_time, scan_error)``, filtered by lower-cased suffix; hidden and system
    folders are skipped. What cannot be read is left out, or with ``errors`` a row."""
    out = list_tree(spark, root)
    if suffixes:
        lower = F.lower(F.col("file_name"))
        wanted = F.regexp_extract(lower, r"(\.[^.]*)$", 1).isin([s.lower() for s in suffixes])
        out = out.filter(wanted | F.col("scan_error").isNotNull())
    return out if errors else out.filter(F.col("scan_error").isNull())


def score_files(files: DataFrame, include: Sequence[str], exclude: Sequence[str] = (), path_col: str = "relative_path") -> DataFrame:
    """SRC2 scoring: keywords contained in the normalized path (relative to the
    root, trap T10); an exclude keyword removes the file, score 0 removes it."""
    key = normalize_text(F.col(path_col), trim=True)
    inc = [folded(k) for k in include]
    exc = [folded(k) for k in exclude]
    scored = files.withColumn("__key", key).withColumn("score", keyword_score(F.col("__key"), inc))
    if exc:
        scored = scored.filter(~reduce(lambda a, b: a | b, [F.col("__key").contains(k) for k in exc]))
    return scored.filter(F.col("score") > 0).drop("__key")


def pick_file(files: DataFrame, include: Sequence[str], exclude: Sequence[str] = (), path_col: str = "relative_path") -> DataFrame:
    """SRC2: the single best file by (score, size, path), all descending."""
    scored = score_files(files, include, exclude, path_col)
    return scored.orderBy(F.desc("score"), F.desc("size_bytes"), F.desc(path_col)).limit(1)


def pick_file_with_fallback(
    files: DataFrame, choices: Sequence[tuple[Sequence[str], Sequence[str]]], path_col: str = "relative_path"
) -> DataFrame:
    """SRC3: first keyword set that finds anything wins (priority column in a
    union, one ordered limit)."""
    parts = None
    for prio, (inc, exc) in enumerate(choices):
        s = score_files(files, inc, exc, path_col).withColumn("choice", F.lit(prio))
        parts = s if parts is None else parts.unionByName(s)
    return parts.orderBy(F.asc("choice"), F.desc("score"), F.desc("size_bytes"), F.desc(path_col)).limit(1)


def delimiter_counts(content: Column, sample_bytes: int = 4096) -> Column:
    """SRC4 helper: counts of each candidate delimiter in the first bytes."""
    head = F.substring(content, 1, sample_bytes)  # binary: bytes, text: characters
    text = head.cast("string")
    return F.struct(*[(F.length(text) - F.length(F.replace(text, F.lit(d), F.lit("")))).alias(f"c{i}") for i, d in enumerate(DELIMITERS)])


def detect_delimiter(content: Column, sample_bytes: int = 4096) -> Column:
    """SRC4: the most frequent of ``,`` ``;`` tab ``|`` in the first
    ``sample_bytes`` bytes, ties to that order, ``,`` when none occurs."""
    counts = delimiter_counts(content, sample_bytes)
    best = F.lit(DELIMITERS[0])
    best_n = counts["c0"]
    for i, d in enumerate(DELIMITERS[1:], start=1):
        better = counts[f"c{i}"] > best_n
        best = F.when(better, F.lit(d)).otherwise(best)
        best_n = F.greatest(best_n, counts[f"c{i}"])
    return F.when(best_n > 0, best).otherwise(F.lit(","))
