"""Toxicity: gradient-boosted trees over dense features, isotonically calibrated.

Labelled rows are split by a hash of doc_id into held-out rows (crc32 of the
doc_id's text mod 5 = 0, never learned from) and three training folds: one
learns the lexicons, one the trees, one the calibration. The lexicons are words
and word beginnings (4 to 6 letters) whose document frequency among toxic rows
is far above that among the others; features are their densities, their
proximity to second-person words, and rates of capitals, punctuation and
obfuscated spellings. Trees and isotonic regression are Spark ML's.

At most about ``MAX_LABELLED`` labelled rows, chosen by hash, and ``MAX_LEXICON``
entries of a lexicon are learned from; every document is scored on its whole text.

Defined results: a null text scores like an empty one; repeated rows score
alike; labels, lang, source and doc_id are no inputs of a score; several labels
of a doc_id count as toxic if any is. Without both classes in a fold the score is
the training rows' toxic share (0 without labels), or uncalibrated. Extra columns
pass through, those named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, join_by_size, spilled, table

MAX_LABELLED = 60_000
MAX_LEXICON = 5_000
#: A lexicon entry needs so many toxic documents, and this log ratio.
LEAST_TOXIC, LEAST_RATIO = 3, 2.0
STEMS = (4, 5, 6)
NEAR = 4

# Second-person words of four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
# Letters that digits and signs stand for.
LEET = str.maketrans("0134578@$!", "oieastbasi")

_WORD = re.compile(r"[^\W\d_]+")
_CHUNK = re.compile(r"\S+")
_DISGUISED = re.compile(r"(?=.*[^\W\d_])(?:.*[^\W\d_][0-9@$!*#+]+[^\W\d_].*|.*([^\W\d_])\1\1.*|[0-9@$][^\W\d_]{2,})$")
_ODD = re.compile(r"[0-9@$!*#+]|([^\W\d_])\1\1")
_SPACED = re.compile(r"(?<!\w)[^\W\d_](?:[ .\-_][^\W\d_]){3,}\b")
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
FEATURES = (
    "word_density", "word_hits", "stem_density", "stem_hits", "hidden_density", "hidden_hits", "top_weight", "mean_weight", "near_second_person",
    "second_person", "capitals", "shouted", "punctuation", "exclaimed", "disguised", "spaced", "length",
)


def stems(word: str):
    return (word[:n] + "-" for n in STEMS if len(word) > n)


def entries(text: str) -> set[str]:
    """Words and word beginnings (marked by a hyphen) of a text."""
    own = set(_WORD.findall(text.lower()))
    return own.union(*(stems(w) for w in own)) if own else own


class WordWeights(dict):
    """word -> (word weight, best stem weight, is second person), for at most 100,000 words."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon

    def __missing__(self, w: str):
        if len(self) >= 100_000:
            self.clear()
        get = self.lexicon.get
        self[w] = got = (get(w, 0.0), max([get(s, 0.0) for s in stems(w)], default=0.0), w in SECOND_PERSON)
        return got


def features(text: str | None, weights: WordWeights) -> list[float]:
    text = text or ""
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words) or 1
    scored = list(map(weights.__getitem__, words))
    hits = [i for i, (a, b, _) in enumerate(scored) if a or b]
    by_word, by_stem = [a for i in hits if (a := scored[i][0])], [b for i in hits if (b := scored[i][1])]
    best = [max(scored[i][:2]) for i in hits]
    address = [i for i, s in enumerate(scored) if s[2]]
    near = 0.0
    if hits and address:
        close = set(address)
        near = sum(max((1 / (1 + abs(d)) for d in range(-NEAR, NEAR + 1) if i + d in close), default=0.0) for i in hits)
    disguised = hidden = 0
    if _ODD.search(low):
        for chunk in _CHUNK.findall(low):
            core = chunk.strip(".,;:!?\"'()")
            if _DISGUISED.match(core):
                disguised += 1
                plain = re.sub(r"(.)\1\1+", r"\1", core.translate(LEET).replace("*", "").replace("#", "").replace("+", ""))
                hidden += plain != core and any(weights[plain][:2])
    spaced = len(_SPACED.findall(low))
    letters = sum(map(len, words)) or 1
    marks = sum(map(text.count, ".,;:!?'\"-()"))
    size = len(text) or 1
    return [
        len(by_word) / n, math.log1p(len(by_word)), len(by_stem) / n, math.log1p(len(by_stem)), hidden / n, math.log1p(hidden), max(best, default=0.0), sum(best) / n, near / n,
        len(address) / n, len(_UPPER.findall(text)) / letters, len(_SHOUTED.findall(text)) / n, marks / size, (text.count("!") + text.count("?")) / size,
        disguised / n, spaced / n, math.log1p(len(words)),
    ]


def featured(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` with ``features``: array<double>."""
    docs = docs.drop("features")
    at = docs.columns.index("text")

    def run(batches):
        weights = WordWeights(lexicon)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = pa.array([features(t, weights) for t in part.column(at).to_pylist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, rows], names=[*part.schema.names, "features"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))]))


def held_out(doc_id="doc_id"):
    """Rows that nothing may be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(text, label, fold) of labelled rows that are not held out; fold 0 to 9."""
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    marks = spilled(marks)
    n = marks.count()
    share = min(1.0, max_labelled / n) if n else 1.0
    draw = F.pmod(F.xxhash64(F.lit("draw"), "doc_id"), F.lit(1_000_000))
    marks = marks.filter(draw < int(share * 1_000_000))
    marks = marks.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(10)).cast("int"))
    # the sample is bounded, so it reaches the documents by a broadcast (its bytes are checked all the same)
    found = join_by_size(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), spilled(marks), "doc_id")
    return spilled(found.select("text", "label", "fold"))


def learn_lexicon(rows: DataFrame, max_entries: int = MAX_LEXICON) -> dict[str, float]:
    """Entries with a high ratio of toxic to other document frequency -> log ratio."""

    def count(batches):
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else other).update(entries(text))
        own = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([toxic[e] for e in own], pa.int64()), pa.array([other[e] for e in own], pa.int64())], names=["entry", "toxic", "other"])

    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    t, o = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if not t or not o:
        return {}
    counts = rows.select("text", "label").mapInArrow(count, "entry string, toxic long, other long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    ratio = F.log((F.col("toxic") + 0.5) / (t + 1.0)) - F.log((F.col("other") + 0.5) / (o + 1.0))
    best = counts.filter(F.col("toxic") >= LEAST_TOXIC).withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO)
    return {r["entry"]: r["ratio"] for r in best.orderBy(F.desc("toxic"), "entry").limit(max_entries).collect()}


class ToxicityModel:
    """Lexicon, trees and calibration; ``score`` adds score and predicted."""

    def __init__(self, lexicon, trees, calibration, prior: float):
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with score (0 to 1) and predicted. A thousandth of the score is the trees'
        own probability, which orders rows inside a step of the calibration."""
        docs, back = aside(docs.drop("score", "predicted"), ("features", "_vector", "_raw", "_probability", "_margin", "_class", "_step"))
        if self.trees is None:
            out = docs.withColumn("score", F.lit(float(self.prior)))
        else:
            out = _raw(self.trees, featured(docs, self.lexicon))
            if self.calibration is not None:
                out = self.calibration.setPredictionCol("_step").transform(out)
                out = out.withColumn("score", F.lit(0.999) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_step"))) + F.lit(0.001) * F.col("_raw"))
            else:
                out = out.withColumn("score", F.col("_raw"))
            out = out.select(*docs.columns, "score")
        return back(out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def _raw(trees, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows.withColumn("_vector", array_to_vector("features")))
    return out.withColumn("_raw", vector_to_array("_probability")[1]).drop("_vector", "_probability", "_margin", "_class", "features")


def _in_order(ready: DataFrame, max_labelled: int) -> DataFrame:
    """The bounded learning rows in an order of their own values, one partition per
    ``MAX_LABELLED``, so that sums and samples while learning, and so the model, do not
    depend on how the documents are stored or which task ends first."""
    return ready.coalesce(max(1, max_labelled // MAX_LABELLED)).sortWithinPartitions("features", "label")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = 20, depth: int = 4) -> ToxicityModel:
    rows = training_rows(docs, labels, max_labelled)
    lexicon = learn_lexicon(rows.filter("fold < 5"))
    ready = spilled(featured(rows.filter("fold >= 5"), lexicon).drop("text"))
    counts = {(r["part"], r["label"]): r["count"] for r in ready.groupBy((F.col("fold") >= 8).alias("part"), "label").count().collect()}
    prior = rows.agg(F.avg("label")).first()[0] or 0.0
    if not (counts.get((False, 0.0)) and counts.get((False, 1.0))):
        return ToxicityModel(lexicon, None, None, prior)
    gbt = GBTClassifier(
        featuresCol="_vector", labelCol="label", predictionCol="_class",
        maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=64, minInstancesPerNode=5, seed=11,
    )
    gbt.setProbabilityCol("_probability").setRawPredictionCol("_margin")
    trees = gbt.fit(_in_order(ready.filter("fold < 8"), max_labelled).select("label", array_to_vector("features").alias("_vector")))
    calibration = None
    if counts.get((True, 0.0)) and counts.get((True, 1.0)):
        calibration = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_step").fit(_raw(trees, _in_order(ready.filter("fold >= 8"), max_labelled)).select("_raw", "label"))
    return ToxicityModel(lexicon, trees, calibration, prior)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` whose predicted class is not toxic."""
    moved, back = aside(docs, ("score", "predicted"))
    return back(train(docs, labels).score(moved).filter("predicted = 0").drop("score", "predicted")).select(*docs.columns)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return train(docs, table(spark, sf_dir, "labels")).score(docs).select("doc_id", held_out().alias("held_out"), "score", "predicted")
