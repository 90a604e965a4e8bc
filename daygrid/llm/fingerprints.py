"""Document fingerprints by order MinHash (native).

A text's k-mers are runs of ``k`` words, each numbered by its occurrence among
equal k-mers of the text. A hash of (k-mer, occurrence) deals them into bins;
in every bin the two minimal ones are selected, put back into text order, and
the ordered pair is hashed. Equal bins therefore need the same k-mers in the
same order, so the likeness follows edit distance rather than set overlap.

Arrays are sorted as packed 64-bit integers (hash above position), which keeps
a text at O(n log n) without any array being built element by element.

Defined results: null text counts as empty; a text without words has the empty
fingerprint (likeness 1 with another empty one, else 0); with fewer than ``k``
words the whole sequence is one k-mer; equal texts have equal fingerprints;
texts are whole, positions reach 2^31 words. A null doc_id sorts as the smallest;
equal doc_ids are ordered by a hash of their text; repeated rows are each
other's neighbours. An empty table gives an empty result, a single row is its
own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, ranges, table, words

K = 2
BIN_BITS = 6
#: Buckets of the ordering: so many times ``spark.sql.shuffle.partitions``.
BUCKETS_PER_PARTITION = 2

_LOW32 = 0xFFFFFFFF
_LOW31 = 0x7FFFFFFF


def _packed(h: Column, position: Column) -> Column:
    return F.shiftleft(h.bitwiseAND(F.lit(_LOW32)), 31).bitwiseOR(position.cast("long"))


def _occurrence(sorted_: Column, x: Column, j: Column) -> Column:
    """How many elements just before index ``j`` share its upper 32 bits (a binary
    search for the start of the run, only where there is a run)."""
    key = F.shiftright(x, 31)
    same = lambda i: F.shiftright(F.get(sorted_, i), 31) == key
    steps = F.array(*[F.lit(1 << b) for b in range(29, -1, -1)])
    search = F.aggregate(steps, F.lit(0), lambda n, step: F.when((j - n - step >= 0) & same(F.greatest(j - n - step, F.lit(0))), n + step).otherwise(n))
    return F.when((j > 0) & same(F.greatest(j - 1, F.lit(0))), search).otherwise(F.lit(0))


def sketch(text: Column, k: int = K) -> Column:
    """The non-empty bins of a text as an array of (bin << 16 | tuple hash)."""
    def grams(w: Column) -> Column:
        n = F.size(w)
        count = F.when(n == 0, 0).otherwise(F.greatest(n - (k - 1), F.lit(1)))
        return F.sort_array(F.transform(ranges(count), lambda i: _packed(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), i)))

    def numbered(s: Column) -> Column:
        return F.sort_array(F.transform(s, lambda x, j: _packed(F.xxhash64(F.shiftright(x, 31), _occurrence(s, x, j)), x.bitwiseAND(F.lit(_LOW31)))))

    def bins(t: Column) -> Column:
        bin_ = lambda x: F.shiftright(x, 63 - BIN_BITS)
        first = lambda x, i: (i == 0) | (bin_(F.get(t, F.greatest(i - 1, F.lit(0)))) != bin_(x))

        def chosen(x: Column, i: Column) -> Column:
            y = F.get(t, i + 1)
            hx, hy = F.shiftright(x, 31), F.shiftright(y, 31)
            before = x.bitwiseAND(F.lit(_LOW31)) < y.bitwiseAND(F.lit(_LOW31))
            pair = F.when(before, F.xxhash64(hx, hy)).otherwise(F.xxhash64(hy, hx))
            value = F.when((bin_(y) == bin_(x)).eqNullSafe(True), pair).otherwise(F.xxhash64(hx))
            return F.shiftleft(bin_(x), 16).bitwiseOR(value.bitwiseAND(F.lit(0xFFFF)))

        return F.filter(F.transform(t, lambda x, i: F.when(first(x, i), chosen(x, i))), lambda v: v.isNotNull())

    return let(let(let(words(text), grams), numbered), bins)


def printed(sk: Column) -> Column:
    """A sketch as a string: six hexadecimal digits (bin, tuple hash) for each bin in use."""
    return F.array_join(F.transform(sk, lambda v: F.lpad(F.lower(F.hex(v)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal bins over bins in use in either; 1 if both sketches are empty."""
    used = F.size(F.array_union(F.transform(a, lambda v: F.shiftright(v, 16)), F.transform(b, lambda v: F.shiftright(v, 16))))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / used)


def with_next(docs: DataFrame, buckets: int | None = None) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, text) dealt into buckets of consecutive doc_ids, plus ghosts.

    Bucket bounds are quantiles of doc_id: ``buckets`` numbers on the driver,
    whatever the input's size. The head (largest row) of every bucket is also
    copied, as a ghost, behind the rows of the next higher one, and the overall
    head behind the lowest; a window per bucket then sees every row's next
    document. Returns the frame and that window.
    """
    spark = docs.sparkSession
    buckets = buckets or BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]) if buckets > 1 else F.array(F.lit(0.5)), F.lit(max(10_000, 20 * buckets)))).first()[0]
    cuts = sorted(set(cuts or []))
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    steps = [1 << b for b in range(max(len(cuts), 1).bit_length() - 1, -1, -1)]
    at = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda n, s: F.when((n + s <= len(cuts)) & (F.get(bounds, n + s - 1) <= F.col("doc_id")), n + s).otherwise(n)
    )
    dealt = docs.withColumn("_bucket", F.coalesce(at, F.lit(0)))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "_tie")
    heads = {r[0]: r[1] for r in dealt.groupBy("_bucket").agg(F.max(order).alias("h")).collect()}
    if not heads:
        return dealt.withColumn("_ghost", F.lit(False)), Window.partitionBy("_bucket").orderBy("_ghost")
    filled = sorted(heads)
    # a head goes behind the rows of the next higher bucket, the highest head behind the lowest bucket
    target = {b: filled[(i + 1) % len(filled)] for i, b in enumerate(filled)}
    head_id = F.create_map(*[F.lit(x) for b in filled for x in (b, heads[b][1])]) if filled else None
    head_tie = F.create_map(*[F.lit(x) for b in filled for x in (b, heads[b][2])])
    goes = F.create_map(*[F.lit(x) for b in filled for x in (b, target[b])])
    is_head = F.col("doc_id").eqNullSafe(head_id[F.col("_bucket")]) & (F.col("_tie") == head_tie[F.col("_bucket")])
    copies = F.when(is_head, F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("g")), F.struct(goes[F.col("_bucket")].alias("b"), F.lit(True).alias("g")))).otherwise(
        F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("g")))
    )
    out = dealt.withColumn("_copy", F.explode(copies)).select("doc_id", "text", "_tie", F.col("_copy.b").alias("_bucket"), F.col("_copy.g").alias("_ghost"))
    return out, Window.partitionBy("_bucket").orderBy("_ghost", F.col("doc_id").desc_nulls_last(), F.col("_tie").desc())


def fingerprint_edits(docs: DataFrame, k: int = K, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text (last third replaced by the
    start of the next document in descending doc_id), with their likenesses."""
    dealt, window = with_next(docs, buckets)
    tail = F.floor(F.col("n_chars") / 3).cast("int")
    own = dealt.withColumn("_next", F.lead("text").over(window)).withColumn("n_chars", F.char_length("text").cast("long"))
    own = own.withColumn("_edited", F.when(~F.col("_ghost"), F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - tail), F.substring("_next", F.lit(1), tail))))
    own = own.withColumn("_sketch", sketch(F.col("text"), k)).withColumn("_edit_sketch", F.when(~F.col("_ghost"), sketch(F.col("_edited"), k)))
    own = own.select("doc_id", "_tie", "_bucket", "_ghost", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "_sketch", "_edit_sketch")
    own = own.withColumn("_next_sketch", F.lead("_sketch").over(window)).filter(~F.col("_ghost"))
    return own.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("_sketch")).alias("fingerprint"),
        printed(F.col("_edit_sketch")).alias("edited_fingerprint"),
        likeness(F.col("_sketch"), F.col("_edit_sketch")).alias("near_edited"),
        likeness(F.col("_sketch"), F.col("_next_sketch")).alias("near_next"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
