"""Conversation structure repair by dynamic programming over a Re-Pair grammar.

Rows of a conversation become one symbol each (role initial and fault). The cheapest
edits that turn the role initials into ``(s?(ua)+)?`` are a shortest path over four
states: nothing yet, after the system row, after a user row, after an assistant row. A symbol
is a 4 x 4 min-plus matrix whose entries are (cost, audit); equal costs are settled by
the audit that is least in ASCII. No audit of one entry is a beginning of another of
equal cost (it would differ by inserts, which cost), so the order holds under
concatenation and a run of rows is the product of its matrices.

Equal conversations are solved once. The different symbol sequences, cut into pieces of
``PIECE`` rows, are compressed with one shared grammar: rounds count the adjacent pairs of all
sequences, and each replaces a set of frequent pairs that cannot overlap by new symbols, until
no pair occurs twice or ``MAX_RULES`` rules exist (that bounds the grammar; it saves less then,
results stay the same). Every rule's matrix is the product of its two sides', made once,
bottom-up, and shared by all conversations; audits are ropes, so a rule's text is
not copied for each user, and ropes are compared by the hashes of their parts. A sequence is
the balanced product of the matrices left in it.

A conversation's rows are ordered by a range sort and repeated rows found by digest, so
a long conversation is spread over tasks; what is put together for one conversation is
its symbols and its audit (a character a row, as the result itself has), and its kept text
runs once through a streaming hash.

Defined results: a null conv_id is a conversation of its own; null roles and texts are one
space; a role that begins with none of s, u, a (or is empty) fits nowhere. Rows of one turn
stand by role, then by text; repeated rows are duplicates. Extra columns play no role; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, join_by_size, rows_of, spilled, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rules of the grammar; 2^12 rows of a piece.
MAX_RULES, PIECE_BITS = 4_096, 12
#: Symbols: clean rows by initial, truncated rows, rows that must go.
SYMBOLS = "suaoSUAOx"
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# --- audits as ropes -----------------------------------------------------------------

_MOD, _BASE = (1 << 61) - 1, 1_000_003


def leaf(text: str) -> tuple:
    """A rope: (length, hash, text or left rope, right rope)."""
    h = 0
    for c in text.encode():
        h = (h * _BASE + c) % _MOD
    return (len(text), h, text, None)


def joined(a: tuple, b: tuple) -> tuple:
    if not a[0]:
        return b
    if not b[0]:
        return a
    return (a[0] + b[0], (a[1] * pow(_BASE, b[0], _MOD) + b[1]) % _MOD, a, b)


def less(a: tuple, b: tuple) -> bool:
    """Whether rope ``a`` stands before ``b``; parts of equal hash are passed over."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x[:2] == y[:2]:
            continue
        if x[3] is None and y[3] is None:
            n = min(x[0], y[0])
            if x[2][:n] != y[2][:n]:
                return x[2][:n] < y[2][:n]
            if x[0] > n:
                left.append(leaf(x[2][n:]))
            if y[0] > n:
                right.append(leaf(y[2][n:]))
        elif y[3] is None or x[3] is not None and x[0] >= y[0]:
            left += [x[3], x[2]]
            right.append(y)
        else:
            left.append(x)
            right += [y[3], y[2]]
    return bool(right)


def text_of(rope: tuple) -> str:
    out, stack = [], [rope]
    while stack:
        _, _, a, b = stack.pop()
        if b is None:
            out.append(a)
        else:
            stack += [b, a]
    return "".join(out)


# --- matrices: {(from, to): (cost, rope)} --------------------------------------------


def _add(matrix: dict, key: tuple, cost: int, rope: tuple) -> None:
    old = matrix.get(key)
    if old is None or cost < old[0] or cost == old[0] and less(rope, old[1]):
        matrix[key] = (cost, rope)


def product(a: dict, b: dict) -> dict:
    out: dict = {}
    for (i, k), (cost, rope) in a.items():
        for (k2, j), (more, rest) in b.items():
            if k == k2:
                old = out.get((i, j))
                if old is None or cost + more <= old[0]:
                    _add(out, (i, j), cost + more, joined(rope, rest))
    return out


_NEXT = {_NONE: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}


def inserts() -> dict:
    """Any number of inserted rows (a second round through the states is never cheaper)."""
    out = {}
    for state in range(4):
        at, n = state, 0
        while (state, at) not in out:
            out[state, at] = (n * INSERT, leaf("I" * n))
            at, n = _NEXT[at], n + 1
    return out


def edits(symbol: str) -> dict:
    """One row: deleted, kept where its role fits, or given the role that fits."""
    out = {(s, s): (DELETE, leaf("D")) for s in range(4)}
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for state, to in _NEXT.items():
            fits = symbol.lower() == ("a" if state == _USER else "u")
            _add(out, (state, to), extra + (KEEP if fits else REROLE), leaf("K" if fits else "R"))
        if symbol.lower() == "s":
            _add(out, (_NONE, _SYSTEM), extra + KEEP, leaf("K"))
    return out


def matrices(rules: list[tuple[int, int]]) -> list[dict]:
    """A matrix for every symbol and, from the first rule up, every rule."""
    before = inserts()
    out = [product(before, edits(s)) for s in SYMBOLS]
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


class Balanced:
    """The product of matrices given one by one, over a binary tree."""

    def __init__(self):
        self.stack: list[tuple[int, dict]] = []

    def add(self, matrix: dict) -> None:
        size = 1
        while self.stack and self.stack[-1][0] == size:
            matrix, size = product(self.stack.pop()[1], matrix), 2 * size
        self.stack.append((size, matrix))

    def best(self) -> tuple[int, str]:
        """Cost and audit from nothing to an accepted end."""
        end = inserts()
        for _, matrix in reversed(self.stack):
            end = product(matrix, end)
        found: dict = {}
        for to in (_NONE, _ASSISTANT):
            if (_NONE, to) in end:
                _add(found, (0, 0), *end[_NONE, to])
        return found[0, 0][0], text_of(found[0, 0][1])


# --- the grammar ----------------------------------------------------------------------


def _flat(pieces: list[bytes]) -> np.ndarray:
    """Symbols of all pieces, -1 behind each."""
    code = np.full(256, -1, np.int64)
    code[list(SYMBOLS.encode())] = np.arange(len(SYMBOLS))
    return code[np.frombuffer(b"".join(p + b"\n" for p in pieces), np.uint8)]


def _pairs_at(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and codes of adjacent pairs; of overlapping equal symbols every other."""
    a, b = seq[:-1], seq[1:]
    at = np.flatnonzero((a >= 0) & (b >= 0))
    same = np.concatenate([[False], a == b])  # same[i]: equal to the symbol before
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(seq)))) if len(seq) else seq
    at = at[(a[at] != b[at]) | ((at - start[at]) % 2 == 0)]
    return at, a[at] << 32 | b[at]


def shortened(seq: np.ndarray, rounds: list[list[tuple[int, int]]]) -> np.ndarray:
    """``seq`` after the replacements of all rounds, in their order."""
    new = len(SYMBOLS)
    for rules in rounds:
        codes = np.array([a << 32 | b for a, b in rules])
        order = np.argsort(codes)
        at, code = _pairs_at(seq)
        found = np.searchsorted(codes[order], code)
        hit = codes[order][np.minimum(found, len(codes) - 1)] == code
        seq = seq.copy()
        seq[at[hit]] = new + order[found[hit]]
        seq = np.delete(seq, at[hit] + 1)
        new += len(rules)
    return seq


def choose(counted: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """Of (pair code, count), most frequent first, those that cannot overlap: no symbol is
    the left of one and the right of another (a doubled symbol stands alone)."""
    lefts, rights, out = set(), set(), []
    for code, _ in counted:
        a, b = code >> 32, code & 0xFFFFFFFF
        if len(out) < room and a not in rights and b not in lefts and (a != b or a not in lefts | rights):
            if a == b:
                lefts.add(a), rights.add(a)
            elif lefts & rights & {a, b}:
                continue
            else:
                lefts.add(a), rights.add(b)
            out.append((a, b))
    return out


def grammar(sequences: DataFrame, max_rules: int = MAX_RULES) -> list[list[tuple[int, int]]]:
    """Rounds of Re-Pair rules for ``sequences`` (column ``syms``: symbols of a piece)."""
    rounds: list[list[tuple[int, int]]] = []
    while (room := max_rules - sum(map(len, rounds))) > 0:

        def count(batches, rounds=rounds):
            total: Counter = Counter()
            for batch in batches:
                _, codes = _pairs_at(shortened(_flat([s.encode() for s in batch.column("syms").to_pylist()]), rounds))
                for code, n in zip(*np.unique(codes, return_counts=True)):
                    total[int(code)] += int(n)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pair", "n"])

        counted = sequences.select("syms").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n >= 2")
        top = [(r["pair"], r["n"]) for r in counted.orderBy(F.desc("n"), "pair").limit(room).collect()]
        rules = choose(top, room)
        if not rules:
            break
        rounds = [*rounds, rules]
    return rounds


def solved(sequences: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """(sid, cost, audit) of ``sequences`` (sid, at, syms): pieces of a sequence in the order of ``at``."""
    rounds = grammar(sequences, max_rules)
    shared = pickle.dumps(matrices([r for rules in rounds for r in rules]))

    def run(batches):
        own, now, total, out = pickle.loads(shared), None, None, []
        for batch in batches:
            for sid, syms in rows_of(batch, "sid", "syms"):
                if sid != now:
                    if total:
                        out.append((now, *total.best()))
                    now, total = sid, Balanced()
                for symbol in shortened(_flat([syms.encode()]), rounds)[:-1]:
                    total.add(own[symbol])
            if out:
                yield _record(out, ("sid", "cost", "audit"), (pa.string(), pa.int64(), pa.string()))
                out = []
        if total:
            yield _record([(now, *total.best())], ("sid", "cost", "audit"), (pa.string(), pa.int64(), pa.string()))

    return sequences.repartition("sid").sortWithinPartitions("sid", "at").select("sid", "syms").mapInArrow(run, "sid string, cost long, audit string")


def _record(rows, names, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


# --- rows -----------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(ck, turn, role, text) after the damage; ck is the conversation's id as text."""
    text_or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20
    hit = rows.select(text_or_space("conv_id").alias("ck"), "turn", text_or_space("role").alias("role"), text_or_space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1))
    return hit.select("ck", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, growing in a conversation's order, and what their text shows."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    first = F.substring("role", 1, 1)
    digest = F.unhex(F.md5(F.concat_ws("\0", "ck", F.length("role").cast("string"), "role", "text").cast("binary")))
    order = ("ck", "turn", "role")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return placed.select(
        "ck",
        F.monotonically_increasing_id().alias("pos"),
        "turn",
        "role",
        "text",
        F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("initial"),
        (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut"),
        digest.alias("digest"),
    )


def _illegal(initials: Column) -> Column:
    """Adjacent initials other than su, ua, au."""
    chars = F.split(initials, "")
    pairs = F.zip_with(chars, F.slice(chars, F.lit(2), F.size(chars)), lambda a, b: F.concat(a, b))
    return F.size(F.filter(pairs, lambda p: p.isNotNull() & ~p.isin("su", "ua", "au"))).cast("long")


def _replayed(batches):
    """SHA-256 of each conversation's repaired rows: the audit comes first (pos -1), then the rows."""
    role_of = {_USER: b"user", _ASSISTANT: b"assistant"}
    initial = {b"s": _SYSTEM, b"u": _USER, b"a": _ASSISTANT}
    now, audit, at, state, sha, lines, out = None, b"", 0, _NONE, None, 0, []

    def emit(line: bytes):
        nonlocal lines
        sha.update(b"\n" * (lines > 0) + line)
        lines += 1

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at : at + 1] == b"I":
            state = _NEXT[state]
            emit(role_of[state] + b":")
            at += 1

    for batch in batches:
        for ck, pos, role, text in rows_of(batch, "ck", "pos", "role", "text"):
            if pos < 0:
                if sha:
                    inserted()
                    out.append((now, sha.hexdigest()))
                now, audit, at, state, sha, lines = ck, role, 0, _NONE, hashlib.sha256(), 0
                continue
            inserted()
            edit = audit[at : at + 1]
            at += 1
            if edit == b"K":
                state = initial[role[:1]]
                emit(role + b":" + text)
            elif edit == b"R":
                state = _NEXT[state]
                emit(role_of[state] + b":" + text)
        if out:
            yield _record(out, ("ck", "repaired_sha256"), (pa.string(), pa.string()))
            out = []
    if sha:
        inserted()
        yield _record([(now, sha.hexdigest())], ("ck", "repaired_sha256"), (pa.string(), pa.string()))


def repaired(conversations: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    rows = spilled(_ordered(damaged(conversations)))
    again = spilled(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")).filter("n > 1").select("digest", "first"))
    light = join_by_size(rows.select("ck", "pos", "turn", "initial", "blank", "cut", "digest"), again, "digest", "left")
    duplicate = ~F.col("blank") & F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    light = light.select("ck", "pos", "turn", "initial", "blank", duplicate.alias("duplicate"), (~F.col("blank") & ~duplicate & F.col("cut")).alias("truncated"))
    symbol = F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), F.upper("initial")).otherwise(F.col("initial"))

    faults = ("blank", "duplicate", "truncated")
    in_order = F.sort_array(F.collect_list(F.struct("pos", symbol.alias("s"), "initial")))
    pieces = light.groupBy("ck", F.shiftright("pos", PIECE_BITS).alias("piece")).agg(in_order.alias("o"), *[F.sum(F.col(f).cast("long")).alias(f) for f in faults])
    pieces = pieces.select("ck", "piece", F.array_join("o.s", "").alias("syms"), F.array_join("o.initial", "").alias("initials"), *faults)
    together = pieces.groupBy("ck").agg(F.sort_array(F.collect_list(F.struct("piece", "syms", "initials"))).alias("p"), *[F.sum(f).alias(f) for f in faults])
    # equal conversations of one piece share an id; a longer one has its own
    sid = F.when(F.size("p") == 1, F.concat(F.lit("="), F.col("p")[0]["syms"])).otherwise(F.concat(F.lit("#"), F.col("ck")))
    together = spilled(together.select("ck", *faults, _illegal(F.array_join("p.initials", "")).alias("illegal"), F.sha2(sid, 256).alias("sid"), F.col("p.syms").alias("syms")))

    sequences = spilled(together.dropDuplicates(["sid"]).select("sid", F.posexplode("syms").alias("at", "syms")))
    answers = spilled(solved(sequences, max_rules))
    told = spilled(join_by_size(together.drop("syms"), answers, "sid").drop("sid"))

    audits = told.select("ck", F.lit(-1).cast("long").alias("pos"), F.col("audit").cast("binary").alias("role"), F.lit(None).cast("binary").alias("text"))
    stream = rows.select("ck", "pos", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text")).unionByName(audits)
    hashes = stream.repartition("ck").sortWithinPartitions("ck", "pos").mapInArrow(_replayed, "ck string, repaired_sha256 string")

    turns = rows.select("ck", "turn").distinct().groupBy("ck").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = ids.join(told, "ck", "left").join(turns, "ck", "left").join(hashes, "ck", "left")
    numbers = ("gaps", *faults, "illegal", "cost")
    return out.select(
        "conv_id",
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(_EMPTY_SHA)).alias("repaired_sha256"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))
