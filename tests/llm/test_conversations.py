"""Repair against a plain row-by-row search, the search against all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from daygrid.llm import conversations as C

ACCEPTED = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(symbols):
    """Cheapest (cost, audit) by keeping the best of every state, row by row."""

    def insert(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                to, new = C._NEXT[s], (c + 5, a + "I")
                best[to] = min(best.get(to, new), new)
        return best

    best = insert({0: (0, "")})
    for x in symbols:
        after = {}
        for s, (c, a) in best.items():
            steps = [(s, c + 2, a + "D")]
            if x != "x":
                extra = 5 if x.isupper() else 0
                to = C._NEXT[s]
                if x.lower() == "s" and s == 0:
                    steps.append((1, c + extra, a + "K"))
                fits = x.lower() == "ua"[to == 3]
                steps.append((to, c + extra + (not fits), a + ("K" if fits else "R")))
            for to, cost, audit in steps:
                after[to] = min(after.get(to, (cost, audit)), (cost, audit))
        best = insert(after)
    return min(best[s] for s in (0, 3) if s in best)


def everything(symbols):
    """The same by trying all edits of a few rows."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
        for edits in itertools.product("DKR", repeat=len(symbols)):
            roles_of = {"D": [""], "K": [None], "R": ["u", "a"]}
            for roles in itertools.product(*[roles_of[e] for e in edits]):
                for inserted in itertools.product("ua", repeat=sum(inserts)):
                    it, out, audit, cost = iter(inserted), "", "", 0
                    for k in range(len(symbols) + 1):
                        for _ in range(inserts[k]):
                            out, audit, cost = out + next(it), audit + "I", cost + 5
                        if k < len(symbols):
                            x, e = symbols[k], edits[k]
                            if x == "x" and e != "D":
                                cost += 10**6
                            out += x.lower() if roles[k] is None else roles[k]
                            audit += e
                            cost += {"D": 2, "K": 0, "R": 1}[e] + (5 if x.isupper() and e != "D" else 0)
                    if ACCEPTED.fullmatch(out) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
    return best


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def brute(rows):
    convs = {r[0]: [] for r in rows}
    for r in damage(rows):
        convs[r[0]].append(r[1:])
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not body:
                fault = "b"
            elif (role, text) in seen:
                fault = "d"
            else:
                fault = "" if body[-1] in ".!?" else "t"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols += "x" if fault in ("b", "d") else initial.upper() if fault else initial
        initials = "".join(r[1][:1] if r[1][:1] in ("s", "u", "a") else "o" for r in own)
        illegal = sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(own) - 1))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = plain(symbols)
        lines, k, state = [], 0, 0
        for e in audit:
            if e == "I":
                state = C._NEXT[state]
                lines.append(("user" if state == 2 else "assistant") + ":")
                continue
            _, role, text = own[k]
            k += 1
            if e == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            elif e == "R":
                state = C._NEXT[state]
                role = "user" if state == 2 else "assistant"
            if e != "D":
                lines.append(f"{role}:{text}")
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def same(got, rows):
    exp = brute(rows)
    assert len(got) == len(exp)
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == exp[r["conv_id"]], r


def test_search_against_all_edits():
    rnd = random.Random(1)
    for n in range(4):
        for _ in range(12):
            s = "".join(rnd.choice(C.SYMBOLS) for _ in range(n))
            assert plain(s) == everything(s), s


def rules_of(seqs, max_rules=100):
    """Rounds as ``grammar`` finds them, without Spark."""
    rounds = []
    while True:
        _, codes = C._pairs_at(C.shortened(C._flat([s.encode() for s in seqs]), rounds))
        counted = sorted(((int(c), int(n)) for c, n in zip(*np.unique(codes, return_counts=True)) if n > 1), key=lambda x: (-x[1], x[0]))
        rules = C.choose(counted, max_rules - sum(map(len, rounds)))
        if not rules:
            return rounds
        rounds.append(rules)


@pytest.mark.parametrize("max_rules", [0, 3, 1000])
def test_grammar_and_matrices(max_rules):
    rnd = random.Random(max_rules)
    seqs = ["".join(rnd.choice(C.SYMBOLS) for _ in range(rnd.randint(1, 60))) for _ in range(80)] + ["ua" * 40, "x" * 33, "xxxx", "sua" * 9, "A"]
    rounds = rules_of(seqs, max_rules)
    rules = [r for rs in rounds for r in rs]
    assert len(rules) <= max_rules
    texts = list(C.SYMBOLS)
    for a, b in rules:
        texts.append(texts[a] + texts[b])
    own = C.matrices(rules)
    for s in seqs:
        short = C.shortened(C._flat([s.encode()]), rounds)[:-1]
        assert "".join(texts[x] for x in short) == s
        total = C.Balanced()
        for x in short:
            total.add(own[x])
        assert total.best() == plain(s), s
    if max_rules == 1000:
        assert len(C.shortened(C._flat([s.encode() for s in seqs]), rounds)) < 0.5 * len("".join(seqs))


def test_ropes():
    rnd = random.Random(4)
    ropes = [C.leaf("".join(rnd.choice("DK") for _ in range(rnd.randint(0, 5)))) for _ in range(30)]
    for _ in range(300):
        ropes.append(C.joined(rnd.choice(ropes), rnd.choice(ropes[-20:])))
    for _ in range(2000):
        a, b = rnd.choice(ropes), rnd.choice(ropes)
        assert C.less(a, b) == (C.text_of(a) < C.text_of(b))


def test_given_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(C.op13(spark, sf).collect(), rows)


def test_long_conversations_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_BITS", 3)
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["system", "user", "assistant", "user", "assistant", "tool"]), rnd.choice(["Yes.", "No!", "so it", "", "why?", f"t{t}."])) for c in range(12) for t in range(rnd.randint(1, 90))]
    same(C.repaired(spark.createDataFrame(rows, SCHEMA), max_rules=40).collect(), rows)


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [
        (None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (1, None, None, None), (1, None, "", "?"), (1, 5, "User", "A."),
        (2, 3, "user", " \t\n"), (2, 3, "user", " \t\n"), (2, 9, "assistant", "é…"), (3, 0, "system", "x."), (4, 0, "s", "s."), (4, 1, "u", "😀!  "),
        (5, 7, "user", "same."), (5, 7, "user", "same."), (5, 7, "assistant", "same."), (6, 0, "user", "w " * 60_000 + "."), (-3, -2, "assistant", "a?\n"),
    ]
    rows += [(10 + i, 0, "user", "Gone?") for i in range(40)]
    extra = {n: F.lit("clash") for n in ("ck", "pos", "kind", "initial", "digest", "sid", "syms", "audit", "cost", "piece")}
    same(C.repaired(spark.createDataFrame(rows, SCHEMA).withColumns(extra)).collect(), rows)
    assert any(v == (0, 0, 0, 0, 0, 0, "", C._EMPTY_SHA) for v in brute(rows).values())
    assert C.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
