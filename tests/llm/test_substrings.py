"""Substring dedup against a brute-force window count."""

import hashlib
import random
import re

from daygrid.llm import substrings


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for d, w in enumerate(words):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = [set() for _ in rows]
    for v in seen.values():
        if len(v) > 1:
            for d, i in v:
                gone[d].update(range(i, i + window))
    return sorted(
        (rows[d][0] if rows[d][0] is not None else -1, len(w), len(g), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest())
        for d, (w, g) in enumerate(zip(words, gone))
    )


def got(df, window):
    rows = substrings.without_repeats(df, window, digest=True).collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"], r["kept_text"]) for r in rows)


def test_planted_passages(spark):
    rnd = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    passages = [rnd.choices(pool, k=k) for k in (34, 35, 36, 50, 90, 200)] + [["x"] * 80, ["p", "q", "r"] * 40]
    rows = []
    for i in range(120):
        w = rnd.choices(pool, k=rnd.randint(0, 200))
        for _ in range(rnd.randint(0, 3)):
            p = list(rnd.choice(passages))
            if rnd.random() < 0.5:  # broken in one place, or cut
                p[rnd.randrange(len(p))] = rnd.choice(pool)
            p = p[rnd.randint(0, 10) :]
            at = rnd.randint(0, len(w))
            w = w[:at] + p + w[at:]
        rows.append((i if i % 11 else 1, rnd.choice([" ", "\n", "\t "]).join(w)))
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, "a b c"), (500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (35, 6):
        assert got(df, window) == brute(rows, window)


def test_texts_are_returned(spark):
    p = " ".join(f"a{i}" for i in range(35))
    df = spark.createDataFrame([(1, f"x {p} y"), (2, f"{p}  z"), (3, "nothing here")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept_text"] for r in substrings.without_repeats(df).collect()} == {1: "x y", 2: "z", 3: "nothing here"}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(odd_docs, 35) == brute(rows, 35)
    assert substrings.without_repeats(no_docs).count() == 0
