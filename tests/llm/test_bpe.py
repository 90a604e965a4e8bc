"""Merge replay against the public library on whole texts and on odd strings."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from daygrid.llm import bpe


def lists(encoded):
    """Ids of every text from the encoder's flat result."""
    flat, sizes = encoded
    ids = iter(flat)
    return [[next(ids) for _ in range(n)] for n in sizes]


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(request.param), "rb"))}
    return bpe._encoder(bpe.read_ranks(P.path(request.param)), P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_documents(both, corpus):
    own, other = both
    texts = [t for _, t in corpus]
    assert lists(own(texts)) == [other.encode_ordinary(t) for t in texts]


def test_odd_strings(both):
    own, other = both
    rnd = random.Random(5)
    pool = "abcAB  \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ​　éßñÄ'12٣½ⅷ%#_-.,ſK漢字😀👩‍👩‍👧﷐\U0010ffff"
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 60))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 3000, "'s're't'll" * 50, "<|endoftext|>", "aaaaabaaaabaaab" * 100]
    texts += [chr(c) + "x " + chr(c) * 2 for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert lists(own(texts)) == [other.encode_ordinary(t) for t in texts]


def test_random_ranks_exercise_lower_ranks_after_a_merge():
    """Vocabularies in which a merge opens a pair of lower rank."""
    rnd = random.Random(9)
    for _ in range(60):
        tokens = [bytes([b]) for b in range(256)]
        more = {"".join(rnd.choices("abc", k=rnd.randint(2, 5))).encode() for _ in range(60)}
        ranks = {t: i for i, t in enumerate(tokens + rnd.sample(sorted(more), len(more)))}
        other = tiktoken.Encoding("r", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(rnd.choices("abc", k=rnd.randint(1, 24))) for _ in range(60)]
        got = bpe.MergeReplay(ranks).encode([w.encode() for w in words])
        assert [list(g) for g in got] == [other.encode_ordinary(w) for w in words]


def test_query(spark, sf, corpus):
    rows = {r["doc_id"]: r for r in bpe.op6(spark, sf).collect()}
    assert len(rows) == len(corpus)
    for i, t in corpus:
        assert rows[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_odd_rows(spark, odd_docs, no_docs):
    out = bpe.decode(bpe.encode(odd_docs.drop("ids")))
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows)
    assert out.columns == [c for c in odd_docs.columns if c != "ids"] + ["ids", "decoded"]
    assert bpe.decode(bpe.encode(no_docs)).count() == 0


def test_round_trip_equals_encode_then_decode(odd_docs, no_docs):
    docs = odd_docs.drop("ids")
    two, one = bpe.decode(bpe.encode(docs)), bpe.round_trip(docs)
    assert one.schema == two.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    bare = bpe.round_trip(docs, keep_text=False)
    assert bare.columns == [c for c in one.columns if c != "text"] and bare.count() == one.count()
    assert bpe.round_trip(no_docs).count() == 0
