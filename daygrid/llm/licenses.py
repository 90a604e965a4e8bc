"""License scans: exact set-similarity join of text blocks with license templates.

Templates and blocks are sets of words. A block meets a template if it contains
at least ``threshold`` of the template's words. A block is any run of consecutive
words, over line ends or inside a long line, that is at most half as long again as
the template, and that has the template's telling words: names of licenses, and
words that tell it from a template of another label which has enough of the others; blocks that
meet the threshold without them are in ``contained`` only (label and containment).
Of templates met in one place, one whose names include another's stands for both. Candidates come from prefix
filtering: the template words are ordered by their frequency in the whole corpus
(counted first), rarest first, and a block that shares ceil(t * n) of n words
must share one of the n - ceil(t * n) + 1 rarest. Shorter texts than that many
words are skipped (length filter), and so is a candidate whose first shared word
stands too far back in both orders to reach the overlap (positional filter).
What remains is counted exactly, by a window that slides over the places of the
template's words.

Beside it three base phrases are found as consecutive words, anywhere.

Templates and their frequencies are bounded by the template list; documents are
read twice and nothing but counts per template word is shuffled.

Defined results: null text counts as empty (no labels, score 0); words are runs
of 0-9, a-z and all characters above U+007F after lower-casing A-Z; the score is
1 with a base phrase, else the largest containment of a met template, else 0;
repeated rows get equal results; extra columns play no role.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# License notices (label, opening words of the public text).
TEMPLATES = (
    ("agpl", "GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("artistic", "distributed under the terms of the Artistic License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Released under the BSD License"),
    ("cc-by", "licensed under a Creative Commons Attribution International License"),
    ("cc-by-nc", "Licensed under CC BY NC"),
    ("cc-by-nd", "Licensed under CC BY ND"),
    ("cc-by-sa", "Licensed under CC BY SA"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike License"),
    ("cc0", "CC0 Universal Public Domain Dedication"),
    ("epl", "made available under the terms of the Eclipse Public License"),
    ("gpl", "licensed under the GNU General Public License"),
    ("gpl", "redistribute it and or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose"),
    ("lgpl", "GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit", "Released under the MIT License"),
    ("mpl", "subject to the terms of the Mozilla Public License"),
    ("reserved", "All rights reserved"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8
# Words that name a license; a template that has them is not met without them.
NAMES = frozenset(b"affero apache artistic bsd cc cc0 commons eclipse gnu lesser mit mozilla nc nd sa sharealike unencumbered".split())
#: Words of a block, as a multiple of its template's.
BLOCK_LENGTH = 1.5

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z, keeps 0-9, a-z, bytes above 0x7F and line feeds, blanks the rest.
_FOLD = bytes(b if b in _KEPT or b > 0x7F or b == 10 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def fold(text: str | None) -> bytes:
    return (text or "").encode().translate(_FOLD)


def template_sets(templates=TEMPLATES) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(fold(t).split())) for label, t in templates]


def word_frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that contain each word of ``vocabulary``, over all documents."""

    def count(batches):
        from collections import Counter

        seen: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for text in batch.slice(at, 512).column(0).to_pylist():
                    seen.update(vocabulary.intersection(fold(text).split()))
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"].encode(): r["n"] for r in rows}


class TemplateJoin:
    """Prefix index over the templates, words in global frequency order."""

    def __init__(self, templates, lengths: list[int], frequency: dict[bytes, int], threshold: float):
        self.rank = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in t}, key=lambda w: (frequency.get(w, 0), w)))}
        self.templates, self.prefix = [], {}
        for label, words in templates:
            need = math.ceil(threshold * len(words) - 1e-9)
            ordered = sorted(words, key=self.rank.__getitem__)
            for at, w in enumerate(ordered[: len(words) - need + 1]):
                self.prefix.setdefault(w, []).append((len(self.templates), at))
            self.templates.append((label, words, need, max(lengths[len(self.templates)] + 2, int(lengths[len(self.templates)] * BLOCK_LENGTH))))
        self.prefix_words = frozenset(self.prefix)
        self.telling = []
        for label, words, need, _ in self.templates:
            others = [words - u for other, u, _, _ in self.templates if other != label and len(words & u) >= need]
            self.telling.append(frozenset(words & NAMES).union(*others))

    def candidates(self, words: set[bytes]) -> list[int]:
        """Templates of which a text has enough words anywhere."""
        known = sorted((w for w in words if w in self.rank), key=self.rank.__getitem__)
        tried, out = set(), []
        for here, w in enumerate(known):
            for t, at in self.prefix.get(w, ()):
                if t in tried:
                    continue
                tried.add(t)
                _, template, need, _ = self.templates[t]
                if len(words) < need or 1 + min(len(known) - here - 1, len(template) - at - 1) < need:
                    continue
                if len(template & words) >= need:
                    out.append(t)
        return out

    def blocks(self, t: int, places: list[tuple[int, bytes]]):
        """(first, last, words shared, whether it has the telling words) of the longest blocks
        that meet template ``t``; ``places``: positions of its words in a text."""
        _, _, need, span = self.templates[t]
        count: dict[bytes, int] = {}
        left = 0
        for at, w in places:
            count[w] = count.get(w, 0) + 1
            while at - places[left][0] >= span:
                gone = places[left][1]
                count[gone] -= 1
                if not count[gone]:
                    del count[gone]
                left += 1
            if len(count) >= need:
                yield places[left][0], at, len(count), self.telling[t] <= count.keys()


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every base phrase in a text's words."""
    out = []
    for phrase, label in BASE:
        parts = phrase.encode().split()
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return out


def scan_text(text: str | None, join: TemplateJoin):
    """(words, base places, {label: containment} as decided, the same of all blocks) of one text."""
    words = fold(text).split()
    present = set(words)
    met: dict[str, float] = {}
    contained: dict[str, float] = {}
    tried = join.candidates(present) if not join.prefix_words.isdisjoint(present) else []
    if tried:
        wanted = frozenset().union(*(join.templates[t][1] for t in tried))
        places = [(i, w) for i, w in enumerate(words) if w in wanted]
        found = {t: list(join.blocks(t, [p for p in places if p[1] in join.templates[t][1]])) for t in tried}
        told = {t: [b for b in blocks if b[3]] for t, blocks in found.items()}
        for t, blocks in found.items():
            label, template = join.templates[t][:2]
            if blocks:
                contained[label] = max(contained.get(label, 0.0), max(b[2] for b in blocks) / len(template))
            above = [b for u in told if join.templates[u][0] != label and template & NAMES and template & NAMES < join.templates[u][1] & NAMES for b in told[u]]
            both = max((n for a, z, n, _ in told[t] if not any(first <= z and a <= last for first, last, _, _ in above)), default=0)
            if both:
                met[label] = max(met.get(label, 0.0), both / len(template))
    base = base_places(words) if {b"by", b"public", b"rights"} & present else []
    return words, base, met, contained


_RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, contained string"


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: words, places of base phrases, labels and score."""
    sets = template_sets(templates)
    frequency = word_frequencies(docs, frozenset(w for _, t in sets for w in t))
    join = TemplateJoin(sets, [len(fold(t).split()) for _, t in templates], frequency, threshold)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words, base, met, contained = scan_text(text, join)
                    own = {label for _, label in base}
                    starts = [i for i, _ in base]
                    out.append((doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(own | met.keys())), 1.0 if base else max(met.values(), default=0.0), ",".join(f"{k}:{v:.4f}" for k, v in sorted(contained.items()))))
                types = (pa.int64(),) * 5 + (pa.string(), pa.string(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in _RESULT.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _RESULT)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
