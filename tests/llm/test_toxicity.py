"""Held-out accuracy, odd rows and degenerate labels of the toxicity model."""

import zlib

import pytest

from daygrid.llm import toxicity as X


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = X.op3(spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    found = [(s >= 0.5, y) for s, y in held]
    assert auc(held) > 0.95
    assert sum(p and y for p, y in found) >= 0.85 * sum(y for _, y in held)
    assert sum(p and not y for p, y in found) <= 0.02 * len(held)


def test_held_out_labels_do_not_matter(spark, sf):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: sorted((r["doc_id"], r["score"]) for r in X.train(docs, lab).score(docs).collect())
    assert score(labels) == score(flipped)


def test_row_order_does_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    score = lambda d: sorted((r["doc_id"], r["score"]) for r in X.train(d, labels).score(docs).collect())
    assert score(docs) == score(docs.repartition(5, "text").sortWithinPartitions("n_chars"))


def test_features_see_disguises():
    lexicon = X.WordWeights({"moron": 4.0, "vequ-": 3.0})
    f = dict(zip(X.FEATURES, X.features("YOU MORON! what a m0r0n, you vequster. i d i o t", lexicon)))
    assert f["word_hits"] > 0 and f["stem_hits"] > 0 and f["hidden_hits"] > 0 and f["near_second_person"] > 0
    assert f["shouted"] > 0 and f["exclaimed"] > 0 and f["disguised"] > 0 and f["spaced"] > 0
    assert set(X.features(None, lexicon)) == {0.0} and len(X.features("", X.WordWeights({}))) == len(X.FEATURES)


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_degenerate_labels_and_odd_rows(spark, odd_docs, no_docs, toxic):
    labels = spark.createDataFrame([(i, 1, toxic) for i in (1, 2, 3, 4, 5, None)], "doc_id long, quality int, toxic int")
    rows = X.train(odd_docs, labels).score(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] == float(toxic or 0) for r in rows)
    assert X.train(no_docs, labels).score(no_docs).count() == 0
