"""Corpus pipeline: filter, deduplicate, redact, mix and encode ``documents``.

Each stage is a function of (spark, docs, sf_dir) over all that the stage before
kept; all but the last return the columns of ``documents``. ``run`` writes every
stage's result to the shared checkpoint folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygrid.llm import bpe, mixing, neardup, secrets, toxicity
from daygrid.llm.common import spilled, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5 (model learned from ``labels``)."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (0.8 of their 5-word shingles)."""
    return neardup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span of the texts replaced; ``n_chars`` follows."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated to their target shares and shuffled globally."""
    return mixing.mix_sources(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the hashes of the ids and of the decoded bytes."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), keep_text=False)
    digests = bpe.digests(coded, "lang", "source", "ids")
    return digests.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix),
    ("bpe_encode", encode),
]

#: Trees and merges have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = spilled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
