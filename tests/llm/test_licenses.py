"""License scan against brute force over all blocks and templates."""

import random
import re

from daygrid.llm import licenses as L

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def words_of(t):
    return [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]


def windows(w, words, span):
    """(first, last, words of the template) in the ``span`` words up to each of its words."""
    for z, x in enumerate(w):
        if x in words:
            inside = [i for i in range(max(0, z - span + 1), z + 1) if w[i] in words]
            yield inside[0], z, {w[i] for i in inside}


def brute(t, threshold=L.THRESHOLD):
    """The present rule, every window of every template looked at from scratch."""
    w = words_of(t)
    places = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    templates = [(label, {x.decode() for x in words}, len(words_of(text))) for (label, words), (_, text) in zip(L.template_sets(), L.TEMPLATES)]
    names = {x.decode() for x in L.NAMES}
    need = lambda words: -(-len(words) * 4 // 5)
    told, contained, met = {}, {}, {}
    for k, (label, words, n) in enumerate(templates):
        telling = (words & names).union(*(words - u for other, u, _ in templates if other != label and len(words & u) >= need(words)))
        found = [b for b in windows(w, words, max(n + 2, n * 3 // 2)) if len(b[2]) >= need(words)]
        told[k] = [b for b in found if telling <= b[2]]
        for b in found:
            contained[label] = max(contained.get(label, 0), len(b[2]) / len(words))
    for k, (label, words, _) in enumerate(templates):
        above = [b for j, (other, u, _) in enumerate(templates) if other != label and words & names and words & names < u & names for b in told[j]]
        for a, z, both in told[k]:
            if not any(first <= z and a <= last for first, last, _ in above):
                met[label] = max(met.get(label, 0), len(both) / len(words))
    own = sorted({label for _, label in places})
    at = [i for i, _ in places]
    labels = ",".join(sorted({*own, *met}))
    listed = ",".join(f"{k}:{v:.4f}" for k, v in sorted(contained.items()))
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(own), labels, 1.0 if places else max(met.values(), default=0.0), listed)


def check(rows, texts):
    for r in rows:
        exp = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == exp[:6]
        assert abs(r["score"] - exp[6]) < 1e-12 and r["contained"] == exp[7]


def test_given_documents(spark, sf, corpus):
    rows = L.op10(spark, sf).collect()
    assert len(rows) == len(corpus)
    check(rows, dict(corpus))


def test_planted_notices(spark):
    rnd = random.Random(4)
    pool = words_of(" ".join(t for _, t in L.TEMPLATES)) + [f"x{i}" for i in range(60)] + ["ſ", "É", "K"]
    texts = {i: "".join(rnd.choice(pool) + rnd.choice([" ", " ", " ", ", ", "\n", " - "]) for _ in range(rnd.randint(0, 80))) for i in range(300)}
    for i, (_, t) in enumerate(L.TEMPLATES):
        texts[1000 + i] = f"Some words before.\n{t.upper()}\nand after"
        cut = t.split()
        texts[2000 + i] = "intro\n" + " ".join(cut[: len(cut) // 2]) + "\n" + " ".join(cut[len(cut) // 2 :])
    texts |= {3000: "CC-BY cc by-nc General  Public\nLicense; all\nrights\nreserved all rights reserved", 3001: "", 3002: None, 3003: "cc cc by by"}
    rows = L.scan_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)
    assert all(r["labels"] for r in rows if 1000 <= r["doc_id"] < 3000)


def test_odd_rows(spark, odd_docs, no_docs):
    assert L.scan_licenses(odd_docs).count() == odd_docs.count() and L.scan_licenses(no_docs).count() == 0


def labels_of(spark, texts):
    rows = L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r["labels"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_notices_over_many_lines(spark):
    """A notice is found however it is wrapped, also inside a long line."""
    for label, t in L.TEMPLATES:
        w = t.split()
        texts = ["/* one\n * " + "\n * ".join(" ".join(w[i : i + n]) for i in range(0, len(w), n)) + "\n */ end" for n in (1, 2, 3)]
        texts.append("word " * 500 + t + " word" * 500)
        assert all(label in got.split(",") for got in labels_of(spark, texts)), t


def test_no_wrong_labels(spark):
    cases = {
        "Released under the MIT License.": "mit", "Released under the BSD License.": "bsd", "Released under the Foo License.": "",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "subject to the terms of the Eclipse Public License": "", "GNU Affero General Public License": "agpl,gpl",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
        "licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
        "Licensed under the Apache License, Version 2.0": "apache-2.0", "All rights reserved.": "reserved",
        "all " + "some words " * 20 + "rights " + "some words " * 20 + "reserved": "",
    }
    assert dict(zip(cases, labels_of(spark, list(cases)))) == cases
