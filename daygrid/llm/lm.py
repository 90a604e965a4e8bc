"""Language-model scoring by prediction by partial matching (PPM).

The model predicts the bytes of a text (A-Z lower-cased) and one end symbol from the
``ORDER`` bytes before, learned beforehand from the training documents. The byte-context
trie is a table: a node's count is a row (gram, c), where a gram is a context with the next
byte, packed into one integer; its parent in the lower order is the gram without its
first byte. Escape probabilities follow method C (different symbols seen over all seen
plus different), and a symbol that a longer context has already ruled out is excluded
from the shorter ones: as everything seen after a context was also seen after its
suffix, what is excluded at order k is what order k + 1 has seen, so the remaining counts
of a node are n_k - sum of c_k over its child's symbols and q_k - q_{k+1}. One join with the
parent and one window over a context (256 rows at most) an order give every gram's log
probability, from the shortest contexts upwards. Below order 0 the bytes not seen yet
are equally likely.

Nothing that grows with the corpus is broadcast or collected. Documents are read
once, as blocks of about ``BLOCK_BYTES`` of text; a block lists its different words and
grams with their training counts, is written to the shared folder, and gets the corpus'
values for just these keys back before its texts. A word or gram that every
document holds is one row a block. Words are known by 64-bit hashes.

Defined results: a null text is empty and has the end symbol only; a null doc_id counts as
the empty string for the split (and is training). Every row gives one result, also
those that share a doc_id; repeated rows count each time. Without training rows every byte
is equally likely and ``base_score`` is 0. Extra columns play no role; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hashed_words, spilled, table

#: Bytes of context; a gram of ORDER + 1 bytes must fit 63 bits.
ORDER = 5
#: Text of a block and of a compressed piece of it.
BLOCK_BYTES, PIECE_BYTES = 32 << 20, 1 << 20
#: Symbols that no UTF-8 text contains: before its start, and after its end.
START, END = 0xFE, 0xFF
SYMBOLS = 256
#: Key of the end token among the hashed words.
END_TOKEN = -1
WORD, GRAM, TEXT = 0, 1, 2

_ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("texts", pa.binary())])


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def grams(texts: list[bytes], order: int, step: int = 1 << 20):
    """(grams, document of each) of all texts with their end symbols, ``step`` at a time."""
    blob = b"".join(bytes([START]) * order + t + bytes([END]) for t in texts)
    ends = np.cumsum([order + len(t) + 1 for t in texts])
    data = np.frombuffer(blob, np.uint8)
    for at in range(order, len(data), step):
        to = min(at + step, len(data))
        packed = np.zeros(to - at, np.int64)
        for back in range(order, -1, -1):
            packed = packed << 8 | data[at - back : to - back]
        real = np.flatnonzero(data[at:to] != START)
        yield packed[real], np.searchsorted(ends, real + at, "right")


class _Counts:
    """Different keys with summed counts; what was added is merged in now and then."""

    def __init__(self):
        self.parts, self.waiting, self.merged = [], 0, 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        """``train``: whether the key's occurrence counts."""
        for mine, counted in ((keys[train], True), (keys[~train], False)):
            if len(mine):
                k, n = np.unique(mine, return_counts=True)
                self.parts.append((k, n if counted else np.zeros_like(n)))
                self.waiting += len(k)
        if self.waiting > max(1 << 20, self.merged):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k, n = (np.concatenate(c) for c in zip(*self.parts))
        by = np.argsort(k, kind="stable")
        k, n = k[by], n[by]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        self.parts = [(k[first], np.add.reduceat(n, first))]
        self.waiting, self.merged = 0, len(first)
        return self.parts[0]


def _pieces(batches, of: int):
    """Rows of the batches in slices of about ``of`` bytes of text, one row at least."""
    for batch in batches:
        sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column("text")], np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // of)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a < b:
                yield batch.slice(a, b - a)


def _texts(piece) -> list[bytes]:
    return [(t or b"").lower() for t in piece.column("text").to_pylist()]


def _gather(order: int):
    """Rows of ``_ROWS``: the texts of blocks, and what occurs in each block."""

    def listed(block, counts):
        for kind, c in zip((WORD, GRAM), counts):
            k, n = c.result()
            if len(k):
                empty = pa.nulls(len(k), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block)), pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n), empty], schema=_ROWS)

    def run(batches):
        block, size, counts = TaskContext.get().partitionId() << 32, 0, (_Counts(), _Counts())
        for piece in _pieces(batches, PIECE_BYTES):
            texts = _texts(piece)
            train = ~piece.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            hashes, bounds = hashed_words(texts)
            ends = np.full(len(texts), END_TOKEN, np.int64)
            counts[0].add(np.concatenate([hashes.view(np.int64), ends]), np.concatenate([np.repeat(train, np.diff(bounds)), train]))
            for g, doc in grams(texts, order):
                counts[1].add(g, train[doc])
            rows = pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(texts, pa.binary())], names=["doc_id", "held_out", "text"])
            packed = pa.BufferOutputStream()
            with pa.ipc.new_stream(packed, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([TEXT], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([packed.getvalue().to_pybytes()], pa.binary())], schema=_ROWS)
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield from listed(block, counts)
                block, size, counts = block + 1, 0, (_Counts(), _Counts())
        yield from listed(block, counts)

    return run


def gram_scores(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of the last byte of every gram after the others.

    ``counted``: (key, n) of all grams of ``order`` + 1 bytes to be scored and of all seen in
    training, n their training counts (0: not seen).
    """
    tables = [counted.select(F.col("key").alias("gram"), F.col("n").alias("c"))]
    for k in range(order - 1, -1, -1):
        tables.insert(0, tables[0].groupBy((F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1)).alias("gram")).agg(F.sum("c").alias("c")))
    tables = [spilled(t) for t in tables]
    seen = F.col("c") > 0
    whole = Window.partitionBy(F.shiftright("gram", 8))  # rows of one context, 256 at most
    level = tables[0].withColumns({"n": F.sum("c").over(whole), "q": F.sum(seen.cast("long")).over(whole)})
    level = level.withColumn("below", -F.log10(F.greatest(SYMBOLS - F.col("q"), F.lit(1)).cast("double")))
    for k in range(1, order + 1):
        suffix = level.select(F.col("gram").alias("suffix"), *[F.col(x).alias(f"{x}_") for x in ("c", "n", "q", "below")])
        level = tables[k].withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * k) - 1)).join(suffix, "suffix")
        level = level.withColumns({"n": F.sum("c").over(whole), "q": F.sum(seen.cast("long")).over(whole), "excluded": F.sum(F.when(seen, F.col("c_")).otherwise(0)).over(whole)})
        room = F.col("n_") - F.col("excluded") + F.col("q_") - F.col("q")
        novel = (F.col("q_") - F.col("q")).cast("double")
        below = F.when(F.col("c_") > 0, F.log10(F.col("c_") / room)).when(novel > 0, F.log10(novel / room) + F.col("below_")).otherwise(F.col("below_"))
        # meant for grams not seen: after a seen one nothing asks for it, and room may be 0
        level = level.withColumn("below", F.when(~seen, below)).select("gram", "c", "n", "q", "below")
    total = F.col("n") + F.col("q")
    value = F.when(seen, F.log10(F.col("c") / total)).when(F.col("n") > 0, F.log10(F.col("q") / total) + F.col("below")).otherwise(F.col("below"))
    return level.select(F.col("gram").alias("key"), value.alias("value"))


class Lookup:
    """Values of known 64-bit keys, many at a time: open addressing, half full at most."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(keys)).bit_length())
        nobody = next(k for k in range(-2, -len(keys) - 4, -1) if not (keys == k).any())
        self.keys, self.values = np.full(1 << self.bits, nobody, np.int64), np.zeros(1 << self.bits)
        left, at = np.arange(len(keys)), self._first(keys)
        while len(left):  # a round gives every key not placed its next slot
            free = left[self.keys[at[left]] == nobody]
            self.keys[at[free]] = keys[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = at[left] + 1 & (1 << self.bits) - 1
        self.values[at] = values

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of ``keys``, all of which are known."""
        at = self._first(keys)
        left = np.flatnonzero(self.keys[at] != keys)
        while len(left):
            at[left] = at[left] + 1 & (1 << self.bits) - 1
            left = left[self.keys[at[left]] != keys[left]]
        return self.values[at]


def _score(order: int, tokens: int, vocabulary: int):
    """Rows of a block in the order words, grams, texts: results of its documents."""

    def results(texts, words, gram_values):
        piece = pa.ipc.open_stream(texts).read_all().combine_chunks()
        docs = piece.column("text").to_pylist()
        hashes, bounds = hashed_words(docs)
        c = words.of(hashes.view(np.int64))
        of = np.repeat(np.arange(len(docs)), np.diff(bounds))
        sum_of = lambda v: np.bincount(of, v, len(docs))
        end = words.of(np.array([END_TOKEN]))[0]
        n_tokens = np.diff(bounds) + 1
        base = sum_of(np.log10(c + 1)) + math.log10(end + 1) - n_tokens * math.log10(tokens + vocabulary + 1)
        score = np.zeros(len(docs))
        for g, doc in grams(docs, order):
            score += np.bincount(doc, gram_values.of(g), len(docs))
        known = (sum_of(c > 0) + (end > 0)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").combine_chunks(), piece.column("held_out").combine_chunks(), pa.array(n_tokens.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    def run(batches):
        now, parts, dictionary = None, None, None
        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if now != block[a]:
                    now, parts, dictionary = block[a], {WORD: [], GRAM: []}, None
                rows = batch.slice(a, b - a)
                if kind[a] != TEXT:
                    parts[kind[a]].append((rows.column("key").to_numpy(), rows.column("value").to_numpy()))
                    continue
                if dictionary is None:
                    dictionary = [Lookup(*map(np.concatenate, zip(*parts.pop(k)))) for k in (WORD, GRAM)]
                for texts in rows.column("texts"):
                    yield results(texts.as_buffer(), *dictionary)

    return run


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6: a gram is one 64-bit number")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    gathered = spilled(rows.mapInArrow(_gather(order), "block long, kind int, key long, n long, texts binary"), "zstd")
    keys = gathered.filter(F.col("kind") != TEXT).select("block", "kind", "key", "n")

    # a word's rows are one for each block that holds it
    of_word = Window.partitionBy("key")
    words = keys.filter(F.col("kind") == WORD).select("block", "kind", "key", F.sum("n").over(of_word).alias("n"), F.row_number().over(of_word.orderBy("block")).alias("at"))
    words = spilled(words, "zstd")
    tokens, vocabulary = words.filter("at = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()

    in_blocks = keys.filter(F.col("kind") == GRAM)
    values = spilled(gram_scores(in_blocks.groupBy("key").agg(F.sum("n").alias("n")), order))
    known = words.select("block", "kind", "key", F.col("n").cast("double").alias("value")).unionByName(in_blocks.join(values, "key").select("block", "kind", "key", "value"))
    texts = gathered.filter(F.col("kind") == TEXT).select("block", "kind", "key", "texts")
    stream = known.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    out = stream.mapInArrow(_score(order, tokens, vocabulary), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(tokens).cast("long"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
