"""Substring dedup by level-wise doubling.

Finds every window of ``window`` words whose word sequence also starts anywhere
else (same document included) and removes the words such windows cover.

Levels: windows of half the length are looked at first, and of those only the
anchors: in every full window, the half-length window with the least hash
(leftmost if equal). The anchor depends on the full window's words alone, so
equal full windows have equal anchors at equal offsets, and one half window in
about ten needs to be compared. Anchors whose words occur once are dropped;
the survivors are extended to twice their length:

* an anchor's context is the stretch of all full windows that chose it. Equal
  contexts repeat as a whole, and no window of theirs needs to be looked at;
* only where one anchor occurs in several contexts are full windows compared,
  one occurrence for each context.

Counting is by grouped aggregates with partial sums (a passage that a third of
all documents share is one row per task), texts are read again instead of being
carried along, and only documents with repeats are shuffled with their text.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged, compared by 64-bit hashes at the
first level and by 128 bits where the result is decided. Defined results: a null
text has no words; texts below the window lose nothing; a repeated row is a
document of its own, so its windows repeat; equal doc_ids and null doc_ids are
told apart by a hash of the text. Extra columns play no role.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RunHasher, hashed_words, mix, rows_of, spilled, table

WINDOW = 35
#: A null doc_id inside the operator.
NO_ID = -(1 << 63)

_ONE, _TWO = RunHasher(np.uint64(0x9E3779B97F4A7C15)), RunHasher(np.uint64(0xC2B2AE3D27D4EB4F))
#: Characters of text that are hashed together.
BLOCK_CHARS = 1 << 20


def tag_of(text: bytes) -> int:
    """24 bits that tell rows of one doc_id apart."""
    return xxhash.xxh3_64_intdigest(text) & 0xFFFFFF


def _leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the least value of every run of ``span`` values, leftmost if equal."""
    best, at = values, np.arange(len(values))
    width = 1
    while width < span:
        step = min(width, span - width)
        n = len(best) - step
        right = best[step:] < best[:n]
        best, at = np.where(right, best[step:], best[:n]), np.where(right, at[step:], at[:n])
        width += step
    return at


def anchors(h: np.ndarray, bounds: np.ndarray, window: int, half: int):
    """Anchors of documents whose words are ``h[bounds[i]:bounds[i + 1]]``: document,
    anchor position, first and last full window that chose it, hash, context hash."""
    n = len(h) - window + 1
    if n <= 0:
        return None
    one, two = _ONE.prefix(h), _TWO.prefix(mix(h))
    starts = np.arange(len(h) - half + 1)
    halves = _ONE.of(one, starts, starts + half)
    chosen = _leftmost_least(halves, window - half + 1)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.flatnonzero(np.arange(n) + window <= bounds[doc + 1])
    if not len(inside):
        return None
    run = np.flatnonzero(np.concatenate([[True], (np.diff(chosen[inside]) != 0) | (np.diff(doc[inside]) != 0)]))
    first, last = inside[run], inside[np.concatenate([run[1:] - 1, [len(inside) - 1]])]
    at = chosen[first]
    context = mix(_TWO.of(two, first, last + window) + (at - first).astype(np.uint64))
    return doc[first], at, first, last, halves[at], context


def _half(window: int) -> int:
    return (window + 1) // 2


def blocks(batch, *names: str):
    """Rows of a batch in blocks of at least one and about ``BLOCK_CHARS`` of text."""
    rows, size = [], 0
    for row in rows_of(batch, *names, step=128):
        rows.append(row)
        size += len(row[1] or "")
        if size >= BLOCK_CHARS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _occurrences(window: int):
    """(doc, key, context, place) of every anchor; place packs first window, number of
    windows and the row's tag into 63 bits."""
    half = _half(window)

    def run(batches):
        for batch in batches:
            for rows in blocks(batch, "doc_id", "text"):
                texts = [(t or "").encode() for _, t in rows]
                h, bounds = hashed_words(texts)
                found = anchors(h, bounds, window, half)
                if found is None:
                    continue
                doc, _, first, last, key, context = found
                ids = np.array([NO_ID if i is None else i for i, _ in rows], np.int64)[doc]
                tags = np.array([tag_of(t) for t in texts], np.int64)[doc]
                place = ((first - bounds[doc]) << 32) | ((last - first + 1) << 24) | tags
                yield _record([ids, key.view(np.int64), context.view(np.int64), place])

    return run


def _record(columns, names=("doc", "key", "context", "place")):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def _unpack(place: np.ndarray, tag: int) -> tuple[np.ndarray, np.ndarray]:
    place = place[(place & 0xFFFFFF) == tag]
    first = place >> 32
    return first, first + ((place >> 24) & 0xFF)


def _full_windows(window: int):
    """(h1, h2, weight, doc, place) of the full windows of marked contexts. Weight 2
    stands for a context that occurs more than once; its windows need no answer."""

    names = ("h1", "h2", "weight", "doc", "place")

    def run(batches):
        for batch in batches:
            for rows in blocks(batch, "doc", "text", "ones", "many"):
                texts = [(r[1] or "").encode() for r in rows]
                h, bounds = hashed_words(texts)
                one, two = _ONE.prefix(h), _TWO.prefix(mix(h))
                out: list[list[np.ndarray]] = [[], [], []]
                for base, text, (doc, _, ones, many) in zip(bounds, texts, rows):
                    tag = tag_of(text)
                    for places, weight in ((ones, 1), (many, 2)):
                        first, end = _unpack(np.array(places or [], np.int64), tag)
                        # all windows of the runs [first, end)
                        size = end - first
                        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(first) else first
                        at = np.unique(at)
                        out[0].append(at + base)
                        out[1].append(np.full(len(at), weight))
                        out[2].append(np.stack([np.full(len(at), doc), (at << 32) | (1 << 24) | tag]))
                at, (doc, place) = np.concatenate(out[0]), np.concatenate(out[2], axis=1)
                yield _record([_ONE.of(one, at, at + window).view(np.int64), _TWO.of(two, at, at + window).view(np.int64), np.concatenate(out[1]), doc, place], names)

    return run


def covered(n: int, first: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts in one of [first, end)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, end + window - 1, -1)
    return np.cumsum(edge[:-1]) > 0


_RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def _kept(window: int, digest: bool):
    def run(batches):
        for batch in batches:
            marked = "places" in batch.schema.names
            names = ("doc_id", "text", "places") if marked else ("doc_id", "text")
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc_id, text, *places in rows_of(batch.slice(at, 256), *names):
                    w = (text or "").encode().split()
                    gone = np.zeros(len(w), bool)
                    if marked:
                        gone = covered(len(w), *_unpack(np.array(places[0], np.int64), tag_of((text or "").encode())), window)
                    kept = b" ".join([x for x, g in zip(w, gone.tolist()) if not g] if gone.any() else w)
                    rows.append((doc_id, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
                ids, n, m, k = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(k, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def repeated_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, places): for every document with repeats, packed runs of repeated windows."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_occurrences(window), "doc long, key long, context long, place long")
    # level 1: contexts and their counts, kept where the anchor occurs more than once
    contexts = spilled(rows.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("rep")))
    by_key = contexts.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).filter("total > 1")
    alive = spilled(contexts.join(by_key, "key").select("key", "context", (F.col("n") > 1).alias("whole"), (F.col("kinds") > 1).alias("compare"), "rep"))
    found = rows.join(alive, ["key", "context"]).select("doc", "place", "whole", (F.col("compare") & (F.col("doc") == F.col("rep"))).alias("compare"))
    found = spilled(found.filter("whole OR compare"))
    # level 2: full windows, one occurrence for each context
    ask = found.filter("compare").groupBy("doc").agg(F.collect_list(F.when(~F.col("whole"), F.col("place"))).alias("ones"), F.collect_list(F.when(F.col("whole"), F.col("place"))).alias("many"))
    windows = spilled(texts.join(ask, "doc").select("doc", "text", "ones", "many").mapInArrow(_full_windows(window), "h1 long, h2 long, weight long, doc long, place long"))
    again = windows.groupBy("h1", "h2").agg(F.sum("weight").alias("n")).filter("n > 1").select("h1", "h2")
    single = windows.filter("weight = 1").join(again, ["h1", "h2"]).select("doc", "place")
    return found.filter("whole").select("doc", "place").unionByName(single).groupBy("doc").agg(F.collect_list("place").alias("places"))


def without_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row; ``digest`` gives the SHA-256
    of the kept text instead of the text. ``window`` is 2 to 255 words."""
    if not 2 <= window <= 255:
        raise ValueError("window must be 2 to 255 words")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    places = spilled(repeated_places(docs, window))
    keyed = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    touched = keyed.join(places, "doc").select("doc_id", "text", "places").mapInArrow(_kept(window, digest), _RESULT)
    rest = keyed.join(places.select("doc"), "doc", "left_anti") if not digest else None
    if rest is not None:
        return touched.unionByName(rest.select("doc_id", "text").mapInArrow(_kept(window, digest), _RESULT))
    # digests of untouched rows are made before the join, so their texts are not shuffled
    plain = rows.mapInArrow(_kept(window, True), _RESULT).withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    return touched.unionByName(plain.join(places.select("doc"), "doc", "left_anti").drop("doc"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept_text", "kept_sha256")


SQL = f"""
WITH w AS (SELECT doc_id, list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '),
                                      lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM w, unnest(range(1, len(w) - {WINDOW - 2})) AS r(i)),
k AS (SELECT doc_id, i FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM k),
n AS (SELECT doc_id, count(*) AS n_removed, list(p) AS gone FROM c GROUP BY doc_id),
u AS (SELECT doc_id, p, w[p] AS word FROM w, unnest(range(1, len(w) + 1)) AS r(p)),
j AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.p) AS kept FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.p = u.p WHERE c.p IS NULL GROUP BY u.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN j USING (doc_id)
"""
