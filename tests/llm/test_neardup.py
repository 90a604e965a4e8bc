"""Near-dedup against brute force: planted edits, chains, large groups, odd rows."""

import random

import numpy as np
import pytest

from daygrid.llm import neardup


def brute(rows):
    """doc_id -> (set size, component) by comparing every pair of documents."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 2]) for k in range(max(len(w) - 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0

    def add(w):
        nonlocal n
        rows.append((n * 7 % 1009, " ".join(w)))
        n += 1

    for _ in range(25):
        base = rnd.choices(words, k=rnd.randint(2, 300))
        add(base)
        for _ in range(rnd.randint(0, 5)):  # edits around the threshold
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 16))):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            add(w)
    chain = rnd.choices(words, k=400)
    for _ in range(40):  # a chain: neighbours are near, ends are not
        chain = list(chain)
        for _ in range(8):
            chain[rnd.randrange(400)] = rnd.choice(words)
        add(chain)
    for _ in range(60):  # unlike the base, alike among themselves only in part
        w = list(chain)
        for k in rnd.sample(range(400), rnd.randint(20, 60)):
            w[k] = rnd.choice(words)
        add(w)
    for t in ("", "one", "ONE", "two", "a b", "A\tB", "a b a b"):
        add(t.split(" ") if t else [])
    return rows


def test_components_match_brute_force(spark, planted):
    got = neardup.near_duplicates(spark.createDataFrame(planted, "doc_id long, text string")).collect()
    exp = brute(planted)
    assert len(got) == len(exp)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == exp[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])


def test_distance_guarantee():
    """Signatures up to the guaranteed distance always share a key."""
    rng = np.random.default_rng(1)
    import pyarrow as pa

    for d in range(neardup.GUARANTEED + 1):
        a = rng.integers(0, 256, neardup.POSITIONS, dtype=np.uint8)
        b = a.copy()
        b[rng.choice(neardup.POSITIONS, d, replace=False)] += 1
        batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([a.tobytes(), b.tobytes()], pa.binary())], names=["rep", "sig"])
        out = next(neardup._chunk_keys([batch])).to_pydict()
        keys = {r: {k for k, q in zip(out["key"], out["rep"]) if q == r} for r in (1, 2)}
        assert keys[1] & keys[2]


def test_signature_follows_similarity():
    w = [f"x{i}" for i in range(2000)]
    s, t = neardup.shingle_sets([" ".join(w), " ".join(w[:1778] + [f"y{i}" for i in range(222)])])
    j = len(np.intersect1d(s, t)) / len(np.union1d(s, t))
    assert abs((neardup.signature(s) == neardup.signature(t)).mean() - j) < 0.2


def test_long_chain_components(spark):
    edges = spark.range(300).selectExpr("(id * 37) % 301 AS a", "((id + 1) * 37) % 301 AS c")
    assert {r["component"] for r in neardup.components(edges).collect()} == {0}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(by) == odd_docs.select("doc_id").distinct().count()
    assert by[2]["n_shingles"] == 0 and by[3]["component_id"] == 3 and by[4]["kept"]
    assert by[8]["component_id"] == 7 and not by[8]["kept"]
    assert by[None]["kept"] and by[None]["component_id"] is None
    assert neardup.near_duplicates(no_docs).count() == 0
    left = neardup.deduplicated(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [-9, 0, 1, 2, 3, 4, 5, 7]


def test_rows_with_one_id_are_one_document(spark):
    """With the links of all their texts."""
    rows = [(5, "a b c d e f g h"), (5, "q r s t u v w x longer"), (3, "a b c d e f g h"), (9, "q r s t u v w x longer"), (9, None), (7, "else where"), (-4, "k l"), (-4, "m n o"), (2, "k l")]
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3: (3, 7, True), 5: (3, 8, False), 9: (3, 8, False), 7: (7, 1, True), -4: (-4, 2, True), 2: (-4, 1, False)}
    kept = neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted(r["doc_id"] for r in kept) == [-4, 3, 7]


@pytest.fixture(scope="module")
def alike():
    """Near copies of one text that share rare words among themselves, in families."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(220)]
    rows = []
    for i in range(420):
        w = list(base)
        family = i % 7
        for k in range(family * 14, family * 14 + 14):  # a family's own words: as far from the base as the limit
            w[k] = f"f{family}_{k}"
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(220)] = f"x{rnd.randrange(100_000)}"
        rows.append((i, " ".join([*w, "rare", "pair"] if i % 3 else w)))
    return rows


@pytest.mark.parametrize("long_list", [0, neardup.LONG_LIST])
def test_shared_rare_pairs_in_a_large_group(spark, alike, monkeypatch, long_list):
    """The same components, whether lists of an element are led anew or joined."""
    monkeypatch.setattr(neardup, "LONG_LIST", long_list)
    rows = alike if long_list else alike[::5]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    exp = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == exp


def test_prefix_bounds_hold_for_every_linked_pair():
    """The first common element of two linked sets lies in the prefixes of both deltas."""
    rnd = random.Random(5)
    holds = lambda bound, **v: eval(bound.replace("AND", "and"), v)  # noqa: E731, S307
    met = 0
    for _ in range(20_000):
        n = rnd.randint(4, 40)
        x = set(rnd.sample(range(60), n))
        y = set(x)
        for _ in range(rnd.randint(0, n // 5)):
            y.symmetric_difference_update({rnd.randrange(60)})
        c = set(rnd.sample(sorted(x & y or x), rnd.randint(1, len(x & y or x)))) | set(rnd.sample(range(60), rnd.randint(0, 30)))
        linked = lambda s, t: 9 * len(s ^ t) <= len(s) + len(t)
        if not linked(x, y) or linked(x, c):
            continue
        order = lambda s: sorted(s ^ c, key=lambda e: (e in c, e))  # noqa: E731, B023
        dx, dy = order(x), order(y)
        common = [e for e in dx if e in dy]
        facts = lambda s, delta: {"at": delta.index(common[0]), "d": len(delta), "size": len(s), "size_c": len(c), "outer": True}  # noqa: E731, B023
        assert holds(neardup._REACH, **facts(x, dx)) and holds(neardup._FIRST, **facts(y, dy))
        met += 1
    assert met > 1000


def test_sizes_far_from_the_leader(spark):
    """Beginnings of one text, of all lengths, with edits: many buckets, sizes unlike the leader's."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(260)]
    rows = []
    for i in range(150):
        w = base[: rnd.randint(30, 260)] if i % 2 else base[rnd.randint(0, 200) :]
        for _ in range(rnd.randint(0, len(w) // 12)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(300)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)


def test_rows_by_element_stay_few_in_a_large_group(spark, monkeypatch):
    """Copies that lack the same words of their leader, but add words of their own: what they
    lack is not joined element by element."""
    rnd = random.Random(13)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for k in rnd.sample(range(150), rnd.randint(8, 16)):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    written, spilled = [], neardup.spilled

    def counted(df, codec=None):
        out = spilled(df, codec)
        if {"element", "a"} <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(neardup, "spilled", counted)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
    assert written and sum(written) <= 150 * len(rows)  # 304 a document when every shared element was joined
