"""PPM scores against a trie of dictionaries, the base score against plain counts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from daygrid.llm import lm

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def brute(rows, order):
    """Results of all rows, by walking a trie symbol by symbol."""
    trie, counts = defaultdict(Counter), Counter()
    data = [(i, (t or "").encode().lower()) for i, t in rows]
    for i, t in data:
        if not held(i):
            s = [lm.START] * order + list(t) + [lm.END]
            for p in range(order, len(s)):
                for k in range(order + 1):
                    trie[tuple(s[p - k : p])][s[p]] += 1
            counts.update([*WORDS.findall(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in data:
        s, total = [lm.START] * order + list(t) + [lm.END], 0.0
        for p in range(order, len(s)):
            excluded = set()
            for k in range(order, -1, -1):
                left = {b: c for b, c in trie.get(tuple(s[p - k : p]), {}).items() if b not in excluded}
                if not left:
                    continue
                size = sum(left.values()) + len(left)
                if s[p] in left:
                    total += math.log10(left[s[p]] / size)
                    break
                total += math.log10(len(left) / size)
                excluded |= set(left)
            else:
                total -= math.log10(lm.SYMBOLS - len(excluded))
        tokens = [*WORDS.findall(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base, total))
    return out


def same(got, exp):
    key = lambda r: (r[0] is None, r[0] or 0, round(r[6], 6))
    got = sorted((tuple(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in got), key=key)
    exp = sorted(exp, key=key)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[:5] == e[:5]
        assert math.isclose(g[5], e[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], e[6], rel_tol=1e-9, abs_tol=1e-9), (g, e)


@pytest.mark.parametrize("order", [1, 3, 4])
def test_given_documents(spark, corpus, order):
    rows = [(i, t[:600]) for i, t in corpus[:120]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.scored(df, order).collect(), brute(rows, order))


def test_several_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lm, "PIECE_BYTES", 500)
    rows = [(i, t[:300]) for i, t in corpus[:60]]
    same(lm.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect(), brute(rows, lm.ORDER))


def test_grams_over_step_bounds():
    texts = [b"abcab" * 9, b"", b"xyz"]
    whole = [(g.tolist(), d.tolist()) for g, d in lm.grams(texts, 4)]
    cut = list(lm.grams(texts, 4, step=7))
    assert [x for g, _ in cut for x in g.tolist()] == whole[0][0] and [x for _, d in cut for x in d.tolist()] == whole[0][1]
    assert len(whole[0][0]) == sum(len(t) + 1 for t in texts)


def test_lookup():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 1000, 40_000):
        keys = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, n), [-1, -2, 0]]))
        rng.shuffle(keys)
        table = lm.Lookup(keys, np.arange(len(keys), dtype=float))
        asked = rng.integers(0, len(keys), 5 * n)
        assert (table.of(keys[asked]) == asked).all()


def test_probabilities_of_a_context_sum_to_one_at_most(spark):
    """Over all 256 symbols after one context, seen or not."""
    text = "abracadabra abrakadabra" * 3
    known = Counter(g for gs, _ in lm.grams([text.encode()], 2) for g in gs.tolist())
    for context in (b"ab", b"zz", b"br"):
        all_ = {int.from_bytes(context + bytes([b]), "big"): 0 for b in range(256)}
        df = spark.createDataFrame(list((all_ | dict(known)).items()), "key long, n long")
        total = sum(10 ** r["value"] for r in lm.gram_scores(df, 2).collect() if r["key"] in all_)
        assert 0.5 < total <= 1 + 1e-9


def test_longer_contexts_predict_held_out_texts_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    short, long = (sum(r["score"] for r in lm.scored(docs, k).filter("held_out").collect()) for k in (2, lm.ORDER))
    assert long > 0.9 * short  # both negative: at least a tenth fewer digits


def test_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    docs = odd_docs.withColumns({n: F.lit("clash") for n in ("block", "kind", "n", "texts", "value", "held_out", "gram", "c")})
    same(lm.scored(docs).collect(), brute([(r["doc_id"], r["text"]) for r in docs.collect()], lm.ORDER))
    assert lm.scored(no_docs).collect() == []
    untrained = next(i for i in range(100) if held(i))
    same(lm.scored(spark.createDataFrame([(untrained, "ab")], "doc_id long, text string")).collect(), brute([(untrained, "ab")], lm.ORDER))
