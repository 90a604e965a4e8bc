"""CSV records whose quoted fields may hold line breaks, without giving up splits (SRC5).

A line of a file ends a record unless it ends inside a quoted field, which depends on
all lines before it. That dependence is one bit, so it is resolved in two passes over
the splits of Spark's text source:

1. every split tells in which state (outside or inside quotes) it ends, for either
   state it may begin in;
2. composed in file order (one entry a split, as in Spark's own file index) these give
   every split's real first state, with which it joins its lines to records. What a
   split holds of records that reach over its bounds goes out as fragments, and the fragments
   of one record are put together by their place.

Records are then parsed by Spark's CSV expression. A quote opens a field only at the
field's beginning, as in Spark's reader.
"""

from __future__ import annotations

import csv
import io
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_LINES = ("file", "start", "line")
_QUOTE = b'"'


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a quoted field is open behind ``line``, read from state ``inside``."""
    if _QUOTE not in line:
        return inside
    at, n = 0, len(line)
    while True:
        if inside:
            quote = line.find(_QUOTE, at)
            if quote < 0:
                return True
            if line[quote + 1 : quote + 2] == _QUOTE:  # a doubled quote is one character
                at = quote + 2
                continue
            inside, at = False, quote + 1
        elif line[at : at + 1] == _QUOTE:
            inside, at = True, at + 1
            continue
        nxt = line.find(sep, at)
        if nxt < 0 or nxt >= n:
            return False
        at = nxt + len(sep)


def _by_split(batches: Iterator[pa.RecordBatch]):
    """((file, start), lines) in file order; a split may come in several pieces."""
    for batch in batches:
        files, starts, lines = (batch.column(c).to_pylist() for c in _LINES)
        a = 0
        for b in range(1, len(lines) + 1):
            if b == len(lines) or (files[b], starts[b]) != (files[a], starts[a]):
                yield (files[a], starts[a]), lines[a:b]
                a = b


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))


def split_states(lines: DataFrame, sep: bytes) -> dict[tuple[str, int], tuple[bool, int | None]]:
    """For each split (file, start): whether it begins inside a quoted field, and then the
    start of the split in which that record begins."""

    def run(batches):
        now, ends, ended = None, [False, True], [False, False]
        out = []
        for split, part in _by_split(batches):
            if split != now:
                if now:
                    out.append((*now, *ends, ended[1]))
                now, ends, ended = split, [False, True], [False, False]
            for line in part:
                if _QUOTE in line:
                    ends = [ends_inside(line, e, sep) for e in ends]
                ended = [was or not e for was, e in zip(ended, ends)]
        if now:
            out.append((*now, *ends, ended[1]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file", "start", "outside", "inside", "ended"])

    found = sorted(map(tuple, lines.mapInArrow(run, "file string, start long, outside boolean, inside boolean, ended boolean").collect()))
    states, file, state, opened = {}, None, False, None
    for name, start, outside, inside, ended in found:
        if name != file:
            file, state, opened = name, False, None
        states[name, start] = (state, opened if state else None)
        if not state or ended:
            opened = start  # what is open behind this split began in it
        state = inside if state else outside
    return states


_PIECES = "file string, opened long, start long, first boolean, record binary"
_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())


def records(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """(file, first, record): every record of the files at ``path`` as text, without its line
    end; ``first`` marks a file's first record. Empty lines outside quotes are no records."""
    lines = _text_lines(spark, path)
    mark = sep.encode()
    states = split_states(lines, mark)

    def run(batches):
        now, inside, parts, key, first, rows = None, False, [], None, False, []

        def piece(complete: bool):
            rows.append((now[0], key if not complete or key is not None else None, now[1], first, b"\n".join(parts)))

        for split, part in _by_split(batches):
            if split != now:
                if parts:
                    key = now[1] if key is None else key
                    piece(False)
                if split not in states:
                    raise RuntimeError(f"{split} was not among the splits read first")
                (inside, key), now, parts, first = states[split], split, [], split[1] == 0 and not states[split][0]
            for line in part:
                inside = ends_inside(line, inside, mark)
                parts.append(line)
                if not inside:
                    if key is not None or len(parts) > 1 or line.rstrip(b"\r"):
                        piece(True)
                        first = False
                    parts, key = [], None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=["file", "opened", "start", "first", "record"])
                rows = []
        if parts:
            key = now[1] if key is None else key
            piece(False)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=["file", "opened", "start", "first", "record"])

    pieces = lines.mapInArrow(run, _PIECES).withColumn("record", F.decode("record", encoding))
    whole = pieces.filter("opened IS NULL").select("file", "first", "record")
    # one piece a split and open record at most
    ordered = F.sort_array(F.collect_list(F.struct("start", "first", "record")))
    over = pieces.filter("opened IS NOT NULL").groupBy("file", "opened").agg(ordered.alias("p"))
    over = over.select("file", F.col("p")[0]["first"].alias("first"), F.array_join("p.record", "\n").alias("record"))
    text = F.when(F.col("record").endswith("\r"), F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    return whole.unionByName(over).withColumn("record", text)


def _safe_names(names: list[str]) -> list[str]:
    """Header names as Spark's reader gives them: empty ones by place, repeated ones with it."""
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_records(spark: SparkSession, path: str, sep: str, encoding: str) -> DataFrame:
    """The CSV files at ``path``, each with a header, as text columns named by a header."""
    rows = records(spark, path, sep, encoding)
    head = rows.filter("first").orderBy("file").select("record").first()
    if head is None:
        return spark.createDataFrame([], StructType([]))
    names = _safe_names(next(csv.reader(io.StringIO(head["record"].removeprefix("\ufeff"), newline=""), delimiter=sep)))
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    parsed = rows.filter("NOT first").select(F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])
