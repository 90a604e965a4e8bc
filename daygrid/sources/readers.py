"""Table readers (SRC5-SRC9, SRC15).

CSV files are read by Spark's splittable CSV source with every column as
text (typing happens later with ``try_cast``), after two small distributed
probes: the delimiter from the first bytes and the encoding (UTF-8 unless
some line does not decode, then Latin-1, which accepts any byte).
"""

from __future__ import annotations

import zipfile
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..session import cut_lineage
from . import canonical as C
from . import files as SF
from . import storage
from .files import DELIMITERS, detect_delimiter
from .records import read_records


@dataclass
class Warnings:
    """Degraded optional sources are reported here instead of failing."""

    items: list[str] = field(default_factory=list)

    def add(self, msg: str) -> None:
        self.items.append(msg)

    def add_rows(self, what: str, rows: DataFrame) -> None:
        """One message for each of the first rows (subject, reason), and the number of all."""
        total = rows.count()
        for r in rows.orderBy(*rows.columns).limit(LISTED_ERRORS).collect():
            self.add(f"{what} {r[0]}: {r[1]}")
        if total > LISTED_ERRORS:
            self.add(f"{what}: {total} in all, the first {LISTED_ERRORS} listed")


def sniff(spark: SparkSession, path: str, sample_bytes: int = 4096) -> tuple[str, str]:
    """SRC4 + SRC5 probes for one CSV/TXT file: (delimiter, encoding).

    The delimiter comes from the first ``sample_bytes`` bytes; the encoding is
    UTF-8 unless some line is not valid UTF-8 anywhere in the file (a
    filter + limit(1) job over the whole file, no data kept)."""
    lines = spark.read.text(path)
    # the first split's rows come in file order; other splits are no file head
    head = lines.filter(F.col("_metadata.file_block_start") == 0).limit(200).agg(F.concat_ws("\n", F.collect_list("value")).alias("t"))
    delim = head.select(detect_delimiter(F.encode("t", "UTF-8"), sample_bytes).alias("d")).first()["d"]
    bad = lines.filter(~F.is_valid_utf8(F.col("value"))).limit(1).count() > 0
    return delim, ("ISO-8859-1" if bad else "UTF-8")


def read_csv(spark: SparkSession, path: str, sep: str | None = None, encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    """SRC5/SRC7: header CSV, all columns as text; delimiter and encoding
    detected unless given. A doubled quote inside a quoted field is one quote.
    Large files are split across tasks by Spark; with ``multi_line`` also quoted
    fields with line breaks are read, over split bounds (see ``records``)."""
    if sep is None or encoding is None:
        d, e = sniff(spark, path)
        sep, encoding = sep or d, encoding or e
    if multi_line:
        return read_records(spark, path, sep, encoding)
    return (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("encoding", encoding)
        .option("inferSchema", "false")
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: dispatch on the lower-cased suffix (csv/txt, parquet).

    Excel workbooks are not read (no Spark source for them)."""
    low = path.lower()
    if low.endswith((".csv", ".txt")):
        return read_csv(spark, path)
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    if low.endswith((".xlsx", ".xls")):
        raise ValueError(f"Excel sources are not supported: {path}")
    raise ValueError(f"Unsupported table format: {path}")


def read_optional(spark: SparkSession, path: str | None, warnings: Warnings, what: str) -> DataFrame | None:
    """SRC8: an optional source that cannot be read is reported and left out."""
    if path is None:
        warnings.add(f"{what} source not found. Continuing without it.")
        return None
    try:
        df = read_table(spark, path)
        df.schema  # resolve now so a broken file fails here
        return df
    except Exception as exc:  # noqa: BLE001 - any read failure degrades the source
        warnings.add(f"Cannot read {what} file {path}: {exc}")
        return None


LEVEL_PART_SCHEMA = "station_code_raw string, time_raw string, level_raw string, param_raw string, _part string, _error string"
_LEVEL_COLUMNS = ("station_code_raw", "time_raw", "level_raw", "param_raw")
#: Rows of an archive member that a task holds at a time, and part errors listed by name.
PART_ROWS, LISTED_ERRORS = 50_000, 1_000


def _part_rows(path: str, rows: int) -> Iterator[pd.DataFrame]:
    """First member of one archive as canonical level rows, ``rows`` at a time."""
    with storage.open_file(path) as archive, zipfile.ZipFile(archive) as zf:
        members = zf.namelist()
        if not members:
            return
        with zf.open(members[0]) as fh:
            for chunk in pd.read_csv(fh, dtype=str, keep_default_na=False, na_values=[""], chunksize=rows):
                found = C.resolve(list(chunk.columns), C.LEVEL)
                if any(found[f.name] is None for f in C.LEVEL if f.required):
                    raise C.MissingColumns("missing required columns")
                yield pd.DataFrame({c: chunk[found[c]] if found[c] else None for c in _LEVEL_COLUMNS}, index=chunk.index)


def _zip_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas body: each archive is opened once and streamed; an unreadable or
    incomplete one ends with one error row."""
    for batch in batches:
        for path in batch["path"]:
            try:
                for frame in _part_rows(path, PART_ROWS):
                    yield frame.assign(_part=path, _error=None).astype(object).where(lambda x: x.notna(), None)
            except Exception as exc:  # noqa: BLE001 - reported as a row
                yield pd.DataFrame([{**dict.fromkeys(_LEVEL_COLUMNS), "_part": path, "_error": f"{type(exc).__name__}: {exc}"}])


def read_zip_parts(spark: SparkSession, root: str, warnings: Warnings | None = None) -> DataFrame:
    """SRC9: every ``*.zip`` under ``root``; the first member of each is read
    as CSV and projected to the level source's canonical columns.

    Archives are dealt to tasks one by one (an archive is not splittable), streamed
    in bounded chunks and read once: rows and errors are written together. A part with an
    error gives no rows, as it cannot be trusted; its error is counted, and
    the first ``LISTED_ERRORS`` by path are named in ``warnings``."""
    files = SF.list_files(spark, root, (".zip",), errors=True)
    paths = cut_lineage(files.filter("scan_error IS NULL").select("path"))
    n = paths.count()
    parts = cut_lineage(paths.repartition(max(1, n)).mapInPandas(_zip_parts, LEVEL_PART_SCHEMA))
    errors = parts.filter(F.col("_error").isNotNull())
    if warnings is not None:
        unread = files.filter("scan_error IS NOT NULL").select(F.col("path").alias("_part"), F.col("scan_error").alias("_error"))
        warnings.add_rows("Could not read level part", errors.select("_part", "_error").unionByName(unread))
    good = join_small(parts.filter(F.col("_error").isNull()), errors.select("_part").distinct(), "_part", "left_anti")
    return good.drop("_error")


def reload_panel(spark: SparkSession, path: str, date_col: str = "date", numeric: Sequence[str] | None = None) -> DataFrame:
    """SRC15: panel written as CSV (text columns) or parquet; the day is
    parsed leniently and numeric columns cast leniently."""
    from ..functions.dates import lenient_timestamp

    if path.lower().rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.option("header", "true").csv(path)
    out = df.withColumn(date_col, F.to_date(lenient_timestamp(F.col(date_col), df.schema[date_col].dataType)))
    if numeric:
        out = out.withColumns({c: F.col(c).try_cast("double") for c in numeric if c in out.columns})
    return out


__all__ = [
    "DELIMITERS",
    "Warnings",
    "sniff",
    "read_csv",
    "read_table",
    "read_optional",
    "read_zip_parts",
    "reload_panel",
]
