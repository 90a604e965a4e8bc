"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Texts are split into pieces; the distinct pieces of a block of documents form
one flat list of byte symbols with links to their neighbours, and an inverted
index maps every mergeable pair (by the rank of its merge) to the positions
where it stands. Merges are applied in rank order over all pieces at once; each
touches only its two neighbours, whose new pairs enter the index. Piece results
are remembered in the task, so a frequent piece is merged once.

The index is built per block of new distinct pieces of a task, not for the whole
corpus at a time: memory stays bounded by the block, and nothing is shuffled. A
vocabulary file is read on the driver (it is below ``MAX_VOCABULARY`` bytes) and
broadcast.

Defined results: null text has the ids of the empty text (none); null ids decode
to null; texts are whole; repeated rows get equal ids; extra columns pass
through, and one named like the result column is replaced.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

MAX_VOCABULARY = 64 << 20
#: Documents of a block, distinct pieces that share an index (one that fits the
#: processor's cache), and distinct pieces a Python worker remembers.
BLOCK = 512
INDEXED = 2_500
REMEMBERED = 350_000
#: White space as the rank files' library understands it (Unicode White_Space).
WHITE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank from a ``.tiktoken`` file (base64 token, blank, rank)."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{path}: more than {MAX_VOCABULARY} bytes")
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line.strip())}


#: A pair of tokens as one number: left << PAIR_BITS | right.
PAIR_BITS = 31
#: How ids are kept in bytes.
PACKED = np.dtype("<i4")


def merge_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of tokens whose bytes together are a token -> that token."""
    out = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                out[left << PAIR_BITS | right] = rank
    return out


class MergeReplay:
    """Merges distinct pieces by rank order over an inverted index."""

    def __init__(self, ranks: dict[bytes, int], merges: dict[int, int] | None = None):
        self.ranks = ranks
        self.merges = merge_ranks(ranks) if merges is None else merges
        self.top = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of every piece."""
        return [np.frombuffer(p, PACKED).tolist() for p in self.packed(pieces)]

    def packed(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of every piece, ``PACKED`` in bytes; one that is a token as a whole
        needs no merges."""
        whole = [self.ranks.get(p) for p in pieces]
        merged = iter(self._replay([p for p, w in zip(pieces, whole) if w is None]))
        return [next(merged) if w is None else w.to_bytes(4, "little") for w in whole]

    def _replay(self, pieces: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        if not len(data):
            return [b"" for _ in pieces]
        ends = np.cumsum([len(p) for p in pieces])
        pairs = self.byte_pairs[data[:-1], data[1:]]
        pairs[ends[:-1] - 1] = -1
        # the index: rank -> left positions of pairs with that merge
        places = np.flatnonzero(pairs >= 0)
        places = places[np.argsort(pairs[places], kind="stable")]
        ranks, first = np.unique(pairs[places], return_index=True)
        index = dict(zip(ranks.tolist(), (part.tolist() for part in np.split(places, first[1:]))))
        after = np.arange(1, len(data) + 1)
        before = np.arange(-1, len(data) - 1)
        after[ends - 1] = -1
        before[ends[:-1]] = -1
        symbols, after, before = self.single[data].tolist(), after.tolist(), before.tolist()
        rank_of = self.merges.get

        waiting = index.get
        for rank in range(self.top):
            now = index.pop(rank, None)
            if now is None:
                continue
            if len(now) > 1:
                now.sort()
            for i in now:
                j = after[i]
                if j < 0 or rank_of(symbols[i] << PAIR_BITS | symbols[j]) != rank:
                    continue
                k, h = after[j], before[i]
                symbols[i], symbols[j], after[i], after[j] = rank, -1, k, -1
                lower = False
                if k >= 0:
                    before[k] = i
                    r = rank_of(rank << PAIR_BITS | symbols[k])
                    if r is not None:
                        lower = r < rank
                        if (at := waiting(r)) is None:
                            index[r] = [i]
                        else:
                            at.append(i)
                if h >= 0:
                    r = rank_of(symbols[h] << PAIR_BITS | rank)
                    if r is not None:
                        lower = lower or r < rank
                        if (at := waiting(r)) is None:
                            index[r] = [h]
                        else:
                            at.append(h)
                if lower:
                    piece = int(np.searchsorted(ends, i, side="right"))
                    self._finish(int(ends[piece - 1]) if piece else 0, symbols, after, before)
        left = np.array(symbols)
        alive = left >= 0
        bounds = [0, *(4 * np.cumsum(alive)[ends - 1]).tolist()]
        ids = left[alive].astype(PACKED).tobytes()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _finish(self, start: int, symbols: list[int], after: list[int], before: list[int]) -> None:
        """The remaining merges of one piece, for the rare merge that opens a pair of a
        rank that the replay has passed: lowest rank first, leftmost if equal. The
        piece's entries in the index are void afterwards, as no pair of it can merge."""
        while True:
            best, place, i = self.top, -1, start
            while i >= 0 and after[i] >= 0:
                r = self.merges.get(symbols[i] << PAIR_BITS | symbols[after[i]], self.top)
                if r < best:
                    best, place = r, i
                i = after[i]
            if place < 0:
                return
            j = after[place]
            symbols[place], symbols[j], after[place], after[j] = best, -1, after[j], -1
            if after[place] >= 0:
                before[after[place]] = place


#: What a Python worker remembers from one task to the next, by vocabulary.
_remembered: dict[str, dict[str, bytes]] = {}


def _splitter(pattern: str):
    import regex

    # the contractions' common first character is tried once
    pattern = pattern.replace("'s|'t|'re|'ve|'m|'ll|'d|", "'(?:s|t|re|ve|m|ll|d)|")
    return regex.compile(pattern.replace(r"\S", f"[^{WHITE}]").replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")).findall


def _encoder(ranks, pattern: str, merges: dict[int, int] | None = None, name: str | None = None):
    """Blocks of texts -> (flat ids, ids per text), remembering the pieces' packed ids."""
    split, replay = _splitter(pattern), MergeReplay(ranks, merges)
    known = _remembered.setdefault(name, {}) if name else {}

    def encode(texts: list[str | None]) -> tuple[np.ndarray, list[int]]:
        if len(known) > REMEMBERED:
            known.clear()
        pieces = [split(t) if t else [] for t in texts]
        fresh = list(set(chain.from_iterable(pieces)).difference(known))
        for at in range(0, len(fresh), INDEXED):
            part = fresh[at : at + INDEXED]
            known.update(zip(part, replay.packed([p.encode() for p in part])))
        texts_ids = [b"".join(map(known.__getitem__, p)) for p in pieces]
        return np.frombuffer(b"".join(texts_ids), PACKED), [len(ids) // 4 for ids in texts_ids]

    return encode


def _vocabulary(path: str | None, pattern: str | None):
    """The ranks of ``path`` (default: the public multilingual file), the pattern, and a
    name under which workers remember pieces."""
    import public_tokenizers as P

    pattern = pattern or P.PATTERN
    ranks = read_ranks(path or P.path("byte_bpe_multi_50k.tiktoken"))
    return ranks, pattern, f"{pattern} {xxhash.xxh3_128_hexdigest(repr(sorted(ranks.items())))}"


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    """Every token's bytes at its rank."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def _ids_column(flat: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes], dtype=np.int32)), pa.array(flat))


def _decoded_column(tokens: list[bytes], ids: pa.Array) -> pa.Array:
    flat, bounds = ids.flatten().to_numpy().tolist(), np.cumsum([0, *(n or 0 for n in pc.list_value_length(ids).to_pylist())]).tolist()
    token = tokens.__getitem__
    return pa.array([b"".join(map(token, flat[a:b])) if there else None for a, b, there in zip(bounds, bounds[1:], ids.is_valid().to_pylist())], pa.binary())


def _with_columns(rows: DataFrame, source: str, added: dict[str, T.DataType], start, keep_source: bool = True) -> DataFrame:
    """``rows`` with the ``added`` columns, made from the column ``source`` block by block;
    ``start()`` gives a task's function from that column to the new ones."""
    rows = rows.drop(*added)
    at = rows.columns.index(source)
    kept = [i for i in range(len(rows.columns)) if keep_source or i != at]
    names = [*(rows.columns[i] for i in kept), *added]

    def run(batches):
        convert = start()
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *convert(part.column(at))], names=names)

    return rows.mapInArrow(run, T.StructType([*(rows.schema.fields[i] for i in kept), *(T.StructField(n, t) for n, t in added.items())]))


IDS, BYTES = T.ArrayType(T.IntegerType(), False), T.BinaryType()


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with ``ids``: array<int>, the text's tokens. No special tokens."""
    ranks, pattern, name = _vocabulary(vocabulary, pattern)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, merge_ranks(ranks)))

    def start():
        to_ids = _encoder(shared.value[0], pattern, shared.value[1], name)
        return lambda texts: [_ids_column(*to_ids(texts.to_pylist()))]

    return _with_columns(docs, "text", {"ids": IDS}, start)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: binary, the bytes of the ids in ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(_tokens(_vocabulary(vocabulary, None)[0]))
    return _with_columns(encoded, "ids", {"decoded": BYTES}, lambda: lambda ids: [_decoded_column(shared.value, ids)])


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, as ``decode(encode(docs))``, by one Python
    worker of a task: a chain of two would hold two workers, each with its vocabulary and
    remembered pieces, and pass the ids between them. ``keep_text`` false drops ``text``."""
    ranks, pattern, name = _vocabulary(vocabulary, pattern)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, merge_ranks(ranks)))

    def start():
        to_ids = _encoder(shared.value[0], pattern, shared.value[1], name)
        tokens = _tokens(shared.value[0])

        def both(texts: pa.Array) -> list[pa.Array]:
            ids = _ids_column(*to_ids(texts.to_pylist()))
            return [ids, _decoded_column(tokens, ids)]

        return both

    return _with_columns(docs, "text", {"ids": IDS, "decoded": BYTES}, start, keep_text)


def digests(encoded: DataFrame, *columns: str) -> DataFrame:
    """doc_id, ``columns``, n_tokens and the hashes of the ids and of the decoded bytes."""
    return encoded.select(
        "doc_id",
        *columns,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False))
