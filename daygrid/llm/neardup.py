"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct shingles, of two words in op2 and of five
where nothing else is asked for (the pipeline's stage). Every distinct set gets a
signature of ``POSITIONS`` min-hashes of ``b`` = 8 bits. Signatures are split into
``CHUNKS`` chunks; two signatures that differ in at most ``GUARANTEED`` positions
agree, by pigeonhole, in some chunk up to one position, so with every single
position of a chunk left out in turn (the allowed chunk errors) they share an
exact key. All pairs below that distance are thus candidates; for a pair at
similarity 0.8 the chance to share no key is 2.4e-5. Candidates are confirmed
on the full sets.

Cost is kept linear in a group's size, and no link between different texts is
lost. Equal sets form a class first. Every bucket (the sets that share a key)
has a leader, its member with the most populous buckets; members are compared
with their leaders only. That yields links, and for every member x of leader c
its delta: the symmetric difference of x and c. Two sets of one bucket share
its leader, and |x ^ y| = |dx ^ dy|, so whatever else is linked is found from
deltas alone: J(x, y) >= 0.8 means 9 |x ^ y| <= |x| + |y|, that is an overlap of
dx and dy of at least (|dx| + |dy| - (|x| + |y|) / 9) / 2. If both are linked to
c they are one component already; otherwise that overlap is at least one, and
an exact prefix-filtered overlap join of the deltas (elements that the leader lacks first,
counted within its group, the rarest before the others) finds all such pairs of members that
are in different components. Buckets whose members are of one component, the leader aside, need no deltas. An element that would pair many members with many gets a leader
among them, and deltas from that, instead.

Defined results: words are split at ASCII white space after lower-casing A-Z; a
null text counts as empty; a text without words has the empty set and links
with nothing; a text with fewer words than a shingle is a set of one. Rows that share a doc_id are one
document that has the links of all their texts; its set size is that of the longest (the greatest if
equally long). Rows with
a null doc_id are returned as they are: component null, kept. Extra columns play
no role. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashed_words, join_by_size, mix, rows_of, spilled, table

CHUNKS, CHUNK = 10, 6
POSITIONS = CHUNKS * CHUNK
#: floor(distance / CHUNKS) <= 1 up to this distance.
GUARANTEED = 2 * CHUNKS - 1

_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)


#: Words of a shingle: op2's, and that of ``deduplicated`` unless asked otherwise.
PAIRS, SHINGLE = 2, 5
#: Bytes of ids up to which a verdict is broadcast to the documents.
VERDICT_BYTES = 64 << 20
#: An element with x members to be joined with y gets a leader of its own where
#: x * y > LONG_LIST * (x + y), in the first RELEADS rounds.
LONG_LIST, RELEADS = 256, 3
#: Nodes of further texts of a repeated doc_id count down from here.
OTHER_TEXTS = -(1 << 62)


def shingle_sets(texts: list[str | None], words: int = PAIRS) -> list[np.ndarray]:
    """For every text the sorted distinct 64-bit hashes of its shingles of ``words`` words."""
    h, bounds = hashed_words([(t or "").encode().lower() for t in texts])
    out: list[np.ndarray] = [h[:0]] * len(texts)
    sizes = np.diff(bounds)
    runs = h  # hashes of all runs of ``n`` words
    for n in range(1, words + 1):
        if n > 1:
            runs = mix(runs[:-1] * np.uint64(0xD6E8FEB86659FD93) + mix(h[n - 1 :])) if len(runs) > 1 else h[:0]
        for i in np.flatnonzero(sizes >= words if n == words else sizes == n):
            a, b = bounds[i], bounds[i + 1]
            out[i] = np.unique(runs[a : b - n + 1]) if n == words else mix(runs[a : a + 1] ^ np.uint64(0x9E3779B97F4A7C15))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        block = _MULT[:, None] * shingles[None, at : at + 2048] + _ADD[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return (mix(least) >> np.uint64(56)).astype(np.uint8)


def _sketch(batches, words: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = shingle_sets(part.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(map(len, sets), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "sig"],
            )


def _chunk_keys(batches):
    """(key, rep) for every chunk and left-out position: 40 bits of signature below
    the number of the (chunk, position)."""
    keep = np.array([[p for p in range(c * CHUNK, (c + 1) * CHUNK) if p != out] for c in range(CHUNKS) for out in range(c * CHUNK, (c + 1) * CHUNK)])
    scale = np.uint64(256) ** np.arange(CHUNK - 1, dtype=np.uint64)
    tags = np.arange(len(keep), dtype=np.uint64) << np.uint64(8 * (CHUNK - 1))
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, POSITIONS)
            keys = (sig[:, keep].astype(np.uint64) * scale).sum(axis=2, dtype=np.uint64) + tags
            reps = np.repeat(part.column("rep").to_numpy(), len(keep))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().astype(np.int64)), pa.array(reps)], names=["key", "rep"])


_COMPARED = "a long, c long, size long, size_c long, linked boolean, delta array<long>"


def _compare(batches, words: int):
    """Full sets of members ``a`` against their leaders ``c``: sizes of both sets, whether
    they are linked, and the delta, elements outside the leader first."""
    leader = (None, None)
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, 64):
            part = list(rows_of(batch.slice(at, 64), "a", "c", "text_a", "text_c"))
            for (a, c, _, text_c), s in zip(part, shingle_sets([p[2] for p in part], words)):
                if leader[0] != text_c:
                    leader = (text_c, shingle_sets([text_c], words)[0])
                added, gone = np.setdiff1d(s, leader[1], assume_unique=True), np.setdiff1d(leader[1], s, assume_unique=True)
                d = len(added) + len(gone)
                out.append((a, c, len(s), len(leader[1]), 9 * d <= len(s) + len(leader[1]), np.concatenate([added, gone]).view(np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())))], names=["a", "c", "size", "size_c", "linked", "delta"])


def compare(pairs: DataFrame, texts: DataFrame, words: int = PAIRS) -> DataFrame:
    """Full sets of distinct (a, c) pairs compared; ``texts``: (rep, text)."""
    member = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    leader = texts.select(F.col("rep").alias("c"), F.col("text").alias("text_c"))
    return pairs.join(member, "a").join(leader, "c").select("a", "c", "text_a", "text_c").mapInArrow(lambda batches: _compare(batches, words), _COMPARED)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, c).

    Alternates large-star and small-star steps, each a grouped minimum joined
    back, until the edges no longer change; every round is written to the shared
    folder. Nodes without an edge to another are left out.
    """
    now = spilled(edges.filter("a <> c").select(F.greatest("a", "c").alias("u"), F.least("a", "c").alias("v")).distinct())
    seen = None
    while True:
        count = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(count):
            break
        seen = tuple(count)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = spilled(small.select("e.u", "e.v").filter("u <> v").distinct())
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads)


def _led(members: DataFrame) -> DataFrame:
    """(bucket, a, c): the members of every bucket but its leader, with the leader."""
    popular = members.groupBy("rep").agg(F.sum("n").alias("popularity"))
    order = F.struct(F.col("popularity"), (-F.col("rep")).alias("low"), F.col("rep").alias("c"))
    ranked = members.join(popular, "rep").select("key", "rep", order.alias("o"))
    leaders = ranked.groupBy("key").agg(F.max("o").alias("o")).select("key", F.col("o.c").alias("c"))
    return members.join(leaders, "key").filter("rep <> c").select(F.col("key").alias("bucket"), F.col("rep").alias("a"), "c")


def _annotated(compared: DataFrame, buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """Compared pairs with the member's component, and whether it is another than the
    leader's. Only pairs from buckets whose members, the leader aside, are of several
    components: in any other bucket no two of them are left to be linked."""
    own = comps.select(F.col("node").alias("a"), F.col("component").alias("comp"))
    comp = F.coalesce("comp", "a")
    several = buckets.join(own, "a", "left").groupBy("bucket").agg(F.min(comp).alias("lo"), F.max(comp).alias("hi")).filter("lo <> hi").select("bucket")
    pairs = buckets.join(several, "bucket", "left_semi").select("a", "c").distinct()
    led = pairs.join(own, "a", "left").withColumn("comp", comp).join(own.toDF("c", "comp_c"), "c", "left")
    led = led.select("a", "c", "comp", (F.col("comp") != F.coalesce("comp_c", "c")).alias("outer"))
    return compared.join(led, ["a", "c"]).select("c", "a", "size", "size_c", F.size("delta").cast("long").alias("d"), "delta", "comp", "outer")


#: Whether an element may be the first of the overlap that a link needs, ``at`` being its place
#: in the delta: of any two members, of any member y with a member x outside the leader's
#: component, and of such an x (see ``_delta_links``).
_SIZED = "4 * (d - at) >= 2 * d + 2 * size_c - 3 * size AND 10 * (d - at) >= 5 * d + 3 * size - 5 * size_c"
_FIRST = f"{_SIZED} AND 18 * (d - at) > 9 * d + size_c - size"
_REACH = f"outer AND {_SIZED} AND 10 * (d - at) >= 9 * d - size - size_c"


def _postings(led: DataFrame) -> DataFrame:
    """(c, element, a, comp, outer, size, d, at, first, reach): the elements of deltas within a
    prefix of their member. ``at`` is an element's place in its delta, the same order for all
    members of c: first elements that c lacks, of these those first that no member of another
    component has, then the rarest in c's group; then those of c in their order of value. (All
    members share c's elements, so counting these would cost most and tell least.)"""
    led = led.withColumn("added", F.expr("CAST((d + size - size_c) div 2 AS INT)"))  # elements that c lacks; they stand first
    names = ("c", "a", "size", "size_c", "d", "comp", "outer", "added")
    new = led.select(*names, F.explode(F.expr("slice(delta, 1, added)")).alias("element"))
    missing = led.select(*names, F.posexplode(F.expr("slice(delta, added + 1, size(delta))")).alias("pos", "element"))
    missing = missing.select(*names, "element", (F.col("added") + F.col("pos")).alias("at"))
    shared = new.groupBy("c", "element").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("c", "element", "n")
    own = Window.partitionBy("c", "a")  # one member's delta
    ranked = new.join(shared, ["c", "element"]).withColumn("at", (F.col("added") - F.row_number().over(own.orderBy(F.desc("n"), F.desc("element")))).cast("int"))
    placed = ranked.drop("n").unionByName(missing).withColumn("first", F.expr(_FIRST)).withColumn("reach", F.expr(_REACH))
    return spilled(placed.filter("first OR reach").select("c", "element", "a", "comp", "outer", "size", "d", "at", "first", "reach"))


def _delta_links(compared: DataFrame, buckets: DataFrame, comps: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Linked (a, c) pairs among members of one bucket that are not yet in one component.

    A member x outside the leader's component meets every y at the elements within both
    their prefixes. x is not linked to c, 9 |dx| > |x| + |c|, so a link needs an overlap above
    (9 |dy| + |c| - |y|) / 18, which bounds y's prefix (and x's, if y is such a member too); and
    as |y| <= |c| + |dy| and |dy| is at least the overlap, one of (9 |dx| - |x| - |c|) / 10, which
    bounds x's. Linked sets differ in size by a quarter at most, and |dx| >= ||x| - |c||, which
    bounds both prefixes where sizes are far from the leader's. Where that would be many pairs for one
    element, its members become a group with a leader of their own: they are compared
    with it, and go through the next round with deltas from it, so the cost stays linear in the
    list. After ``RELEADS`` rounds lists of any length are joined directly.
    """
    links = []
    for turn in range(RELEADS + 1):
        led = spilled(_annotated(compared, buckets, comps))
        postings = _postings(led)
        lists = postings.groupBy("c", "element").agg(F.sum(F.col("reach").cast("long")).alias("x"), F.sum(F.col("first").cast("long")).alias("y"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        lists = spilled(lists.filter("x > 0 AND y > 0 AND lo <> hi").select("c", "element", F.expr(f"{turn < RELEADS} AND x * y > {LONG_LIST} * (x + y)").alias("long")))
        open_ = postings.join(lists, ["c", "element"])
        names = ("a", "size", "d", "comp", "at", "outer", "first")
        short = open_.filter("NOT long")
        x = short.filter("reach").select("c", "element", *[F.col(n).alias(f"{n}_x") for n in names])
        y = short.filter("first").select("c", "element", *[F.col(n).alias(f"{n}_y") for n in names])
        need = "(9 * (d_x + d_y) - (size_x + size_y))"
        near = f"comp_x <> comp_y AND 18 * (d_x - at_x) >= {need} AND 18 * (d_y - at_y) >= {need}"
        met = x.join(y, ["c", "element"]).filter(f"(NOT outer_y OR first_x AND a_x < a_y) AND {near}").select("c", "a_x", "a_y").distinct()
        delta = lambda n: led.select("c", F.col("a").alias(f"a_{n}"), F.col("size").alias(f"size_{n}"), F.col("d").alias(f"d_{n}"), F.col("delta").alias(f"delta_{n}"))  # noqa: E731, B023
        sure = met.join(delta("x"), ["c", "a_x"]).join(delta("y"), ["c", "a_y"]).withColumn("both", F.size(F.array_intersect("delta_x", "delta_y")))
        links.append(spilled(sure.filter(f"18 * both >= {need}").select(F.col("a_x").alias("a"), F.col("a_y").alias("c"))))
        if turn == RELEADS or lists.filter("long").isEmpty():
            break
        members = open_.filter("long").select("c", "element", "a")
        leaders = members.groupBy("c", "element").agg(F.min(F.struct(F.xxhash64("a"), F.col("a"))).alias("o")).select("c", "element", F.col("o.a").alias("leader"))
        buckets = spilled(members.join(leaders, ["c", "element"]).filter("a <> leader").select(F.struct("c", "element").alias("bucket"), "a", F.col("leader").alias("c")))
        compared = spilled(compare(buckets.select("a", "c").distinct(), texts, words))
        links.append(spilled(compared.filter("linked").select("a", "c")))
        comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("c")).unionByName(links[-1]).unionByName(links[-2]))
    return reduce(DataFrame.unionByName, links)


def repeated_ids(docs: DataFrame) -> DataFrame:
    """doc_ids of more than one row."""
    return spilled(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"))


def one_row_each(source: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) with one row for each doc_id (rows without one stay), and the other
    texts of repeated doc_ids as (node, doc_id, text), if there are any."""
    again = repeated_ids(source)
    if again.isEmpty():
        return source, None
    texts = spilled(join_by_size(source, again, "doc_id", "left_semi").distinct())
    longest = texts.groupBy("doc_id").agg(F.max(F.struct(F.char_length("text"), F.col("text"))).alias("t")).select("doc_id", "t.text")
    rest = texts.filter("text IS NOT NULL").join(longest, ["doc_id", "text"], "left_anti")
    rest = spilled(rest.select((F.lit(OTHER_TEXTS) - F.monotonically_increasing_id()).alias("node"), "doc_id", "text"))
    return join_by_size(source, again, "doc_id", "left_anti").unionByName(longest), rest


def near_duplicates(docs: DataFrame, words: int = PAIRS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each doc_id, over shingles
    of ``words`` words."""
    source, rest = one_row_each(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    if rest is not None:
        source = source.unionByName(rest.select(F.col("node").alias("doc_id"), "text"))
    sketched = spilled(source.mapInArrow(lambda batches: _sketch(batches, words), "doc_id long, n_shingles long, set_id binary, sig binary"))
    known = sketched.filter("doc_id IS NOT NULL")
    reps = spilled(known.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig")))
    keys = reps.select("rep", "sig").mapInArrow(_chunk_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi").select("key", "n")
    members = spilled(keys.join(shared, "key"))

    buckets = spilled(_led(members))
    pairs = spilled(buckets.select("a", "c").distinct())
    used = spilled(pairs.select(F.explode(F.array("a", "c")).alias("rep")).distinct())
    texts = join_by_size(source.withColumnRenamed("doc_id", "rep"), used, "rep", "left_semi")
    compared = spilled(compare(pairs, texts, words))
    links = spilled(compared.filter("linked").select("a", "c"))
    comps = components(links)
    more = spilled(_delta_links(compared, buckets, comps, texts, words))
    edges = comps.select(F.col("node").alias("a"), F.col("component").alias("c")).unionByName(more)
    if rest is not None:  # all texts of a doc_id are one document
        by_set = known.select(F.col("doc_id").alias("node"), "set_id").join(reps.select("set_id", "rep"), "set_id").select("node", "rep")
        edges = edges.unionByName(rest.select(F.col("node").alias("a"), F.col("doc_id").alias("c"))).unionByName(by_set.select(F.col("node").alias("a"), F.col("rep").alias("c")))
    comps = components(edges)
    comps = comps.withColumnRenamed("node", "rep")
    by_class = reps.select("set_id", "rep").join(comps, "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component"))
    per_id = known.select("doc_id", "n_shingles", "set_id").join(by_class, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    if rest is not None:  # the smallest node may be one of the other texts
        per_id = per_id.join(rest.select(F.col("node").alias("doc_id")), "doc_id", "left_anti")
        least = per_id.groupBy("component_id").agg(F.min("doc_id").alias("least"))
        per_id = per_id.join(least, "component_id").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
    unnamed = sketched.filter("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return per_id.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(unnamed)


def deduplicated(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``docs`` without near duplicates: one row of each group of documents stays (of
    repeated rows of a doc_id, any one); rows without a doc_id stay.

    The texts are not shuffled for the verdict while the ids to drop take
    ``VERDICT_BYTES`` at most (counted); beyond that it is an ordinary anti join.
    """
    verdict = spilled(near_duplicates(docs, words))
    gone = verdict.filter("NOT kept").select("doc_id")
    again = repeated_ids(docs)
    if again.isEmpty():
        return join_by_size(docs, gone, "doc_id", "left_anti", VERDICT_BYTES).select(*docs.columns)
    single = join_by_size(docs, gone.unionByName(again), "doc_id", "left_anti", VERDICT_BYTES)
    repeated = join_by_size(join_by_size(docs, again, "doc_id", "left_semi"), gone, "doc_id", "left_anti", VERDICT_BYTES).dropDuplicates(["doc_id"])
    return single.unionByName(repeated).select(*docs.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), PAIRS)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split(translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN z zx ON zx.doc_id = x JOIN z zy ON zy.doc_id = y WHERE 100 * k >= 80 * (zx.n + zy.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.c),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN z USING (doc_id)
"""
