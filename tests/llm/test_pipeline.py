"""The pipeline's stages against brute force on the smallest tables."""

import hashlib
import random

import corpus_pipeline as P
from daygrid.llm import queries
from daygrid.llm.common import spilled


def test_stages(spark):
    sf = "/root/testdata/sf0.01"  # enough labels to learn from
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        out = spilled(stage(spark, docs, sf))
        seen[name] = (docs, out)
        docs = out
    for name, (before, after) in list(seen.items())[:-1]:
        assert after.columns == before.columns, name
    before, after = seen["toxicity"]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 1").collect()}
    gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    clean = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 0").collect()}
    assert gone & toxic and len(gone & clean) <= 0.01 * len(clean)
    before, after = seen["near_dedup"]  # five words, the width where no contract says otherwise
    assert sorted(r["doc_id"] for r in after.collect()) == brute_kept([(r["doc_id"], r["text"]) for r in before.collect()])
    before, after = seen["secret_scan"]
    texts = {r["doc_id"]: r for r in after.collect()}
    assert len(texts) == before.count()
    assert all(("AKIA" in r["text"]) <= ("[SECRET]" in texts[r["doc_id"]]["text"]) and texts[r["doc_id"]]["n_chars"] == len(texts[r["doc_id"]]["text"]) for r in before.collect())
    before, after = seen["mix_sources"]
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}
    before, after = seen["bpe_encode"]
    rows = sorted((r["doc_id"], r["decoded_sha256"]) for r in after.collect())
    assert rows == sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in before.collect())


def test_run_and_registry(spark, sf):
    assert P.run(spark, sf).count() > 0
    assert [n for n in queries.QUERIES if n.startswith("op")] and set(queries.ORACLE) <= set(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))


def brute_kept(rows, words=5):
    """doc_ids that stay: the smallest of every group linked at 0.8 of all shingles."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))} if w else set()
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            k = len(sets[a] & sets[b]) if a < b and group[a] != group[b] else 0
            if k and 100 * k >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return sorted(i for i, g in group.items() if i == g)


def test_near_dedup_takes_five_words(spark, corpus):
    rnd = random.Random(8)
    rows = []
    for _ in range(25):
        base = [f"w{rnd.randrange(2000)}" for _ in range(rnd.randint(1, 300))]
        for _ in range(4):  # scattered edits: near by pairs of words, not by fives
            rows.append(base := list(base))
            for _ in range(rnd.randint(0, len(base) // 18)):
                base[rnd.randrange(len(base))] = f"n{rnd.randrange(2000)}"
    rows = [(100_000 + i * 7 % 1009, " ".join(w)) for i, w in enumerate(rows)] + corpus + [(-1, "a b c d"), (-2, "A b\tc d"), (-3, "a b c"), (-4, "a b c d e"), (-5, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exp = brute_kept(rows)
    assert exp != brute_kept(rows, 2)
    assert sorted(r["doc_id"] for r in P.drop_near_duplicates(spark, docs, None).collect()) == exp
