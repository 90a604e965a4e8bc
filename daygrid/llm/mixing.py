"""Mixing sources to target weights by Poisson replication (native).

Each source gets a target share of the mixture; share x budget / own size is
its mean repetition rate. A document's number of copies is a Poisson variate
with that mean, by inversion: a uniform number hashed from the seed and the
document is looked up in the source's cumulative distribution. Rates above
``CHUNK`` are split into equal parts whose variates add up (a sum of Poisson
variates is Poisson), so no rate is capped. Documents are exploded by their
count and shuffled globally: a hash of (seed, document, copy) is the position,
and ranges of positions are the output partitions.

Only counts per source are aggregated; the rates reach the documents by a
broadcast whose bytes are checked, else by a join with salted sources.

Defined results: a null source counts as the source ``''``; a null text is
replicated like any other row; a null doc_id draws by its text; repeated rows
draw alike; sources without a weight (explicit weights) have rate 0; an empty
table gives an empty mixture; input columns pass through, those named like a
result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import aside, let, ranges, spilled, table

SEED = 17
#: Weights without explicit targets: documents of a source to this power.
TEMPER = 0.5
#: Largest Poisson mean that is inverted in one piece, and terms of its table
#: (the tail behind them is below 1e-16).
CHUNK = 16.0
TERMS = 96
SALTS = 64


def uniform(seed: int, key: Column, part: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key, part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_table(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, TERMS values."""
    grow = lambda s, k: let(
        s["p"] * mean / (k + 1), lambda p: F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))
    )
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all"))
    return F.aggregate(ranges(F.lit(TERMS - 1)), start, grow, lambda s: s["all"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, budget: int | None = None) -> DataFrame:
    """One row per source: ``_source n_docs rate parts cdf``.

    ``weights`` are target shares (any positive scale); without them a source
    weighs its document count to the power ``TEMPER``. ``budget`` is the expected
    number of documents of the mixture (as many as there are).
    """
    counts = spilled(docs.groupBy(F.coalesce("source", F.lit("")).alias("_source")).agg(F.count(F.lit(1)).alias("n_docs")))
    if weights is None:
        w = F.pow(F.col("n_docs").cast("double"), F.lit(TEMPER))
    elif weights:
        listed = F.create_map(*[F.lit(x) for s, v in weights.items() for x in (s, float(v))])
        w = F.coalesce(listed[F.col("_source")], F.lit(0.0))
    else:
        w = F.lit(0.0)
    weighed = counts.withColumn("_w", w)
    total, all_docs = weighed.agg(F.sum("_w"), F.sum("n_docs")).first()
    size = float(all_docs or 0) if budget is None else float(budget)
    rate = F.lit(0.0) if not total else F.lit(size) * F.col("_w") / F.lit(float(total)) / F.col("n_docs")
    rated = weighed.withColumn("rate", rate).withColumn("parts", F.greatest(F.ceil(F.col("rate") / CHUNK), F.lit(1)).cast("int"))
    return spilled(rated.withColumn("cdf", poisson_table(F.col("rate") / F.col("parts"))).drop("_w"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, budget: int | None = None, seed: int = SEED, max_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` replicated and shuffled, with ``rate n_copies copy mix_key``."""
    spark = docs.sparkSession
    rates = source_rates(docs, weights, budget).drop("n_docs")
    docs, back = aside(docs.drop("rate", "n_copies", "copy", "mix_key"), ("_source", "_key", "_salt", "parts", "cdf"))
    keyed = docs.withColumn("_source", F.coalesce("source", F.lit("")))
    n_sources = rates.count()
    if n_sources * (TERMS * 8 + 512) <= max_bytes:
        drawn = keyed.join(F.broadcast(rates), "_source")
    else:
        salted = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int")
        drawn = keyed.withColumn("_salt", salt).join(salted, ["_source", "_salt"]).drop("_salt")
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    variate = lambda j: let(uniform(seed, key, j), lambda u: F.size(F.filter("cdf", lambda c: c <= u)))
    count = F.aggregate(F.transform(ranges(F.col("parts")), variate), F.lit(0), lambda a, b: a + b)
    copies = drawn.withColumn("_key", key).withColumn("n_copies", F.when(F.col("rate") > 0, count).otherwise(F.lit(0)))
    copies = copies.filter("n_copies > 0").withColumn("copy", F.explode(ranges(F.col("n_copies"))))
    position = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}-order"), "_key", F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    mixed = back(copies.withColumn("mix_key", position).drop("_source", "_key", "parts", "cdf"))
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # positions are uniform on [0, 2^60): equal ranges of them are equal partitions
    return mixed.repartitionById(slices, F.floor(F.col("mix_key") / F.lit(2.0**60) * slices).cast("int")).sortWithinPartitions("mix_key")


def op1(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 6))


SQL = f"""
WITH d AS (SELECT *, coalesce(source, '') AS src FROM documents),
r AS (SELECT src, count(*) AS n, pow(count(*)::DOUBLE, {TEMPER}) AS w FROM d GROUP BY src),
q AS (SELECT src, (SELECT sum(n) FROM r)::DOUBLE * w / (SELECT sum(w) FROM r) / n AS rate FROM r),
p AS (SELECT src, rate, greatest(ceil(rate / {CHUNK}), 1)::INTEGER AS parts FROM q),
t AS (SELECT src, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1))) OVER (PARTITION BY src ORDER BY k) AS c
      FROM p, (SELECT unnest(range({TERMS})) AS k)),
x AS (SELECT d.*, p.rate, p.parts, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key FROM d JOIN p USING (src)),
u AS (SELECT x.*, ('0x' || substr(md5('{SEED}|' || key || '|' || j), 1, 13))::BIGINT / pow(2, 52) AS u
      FROM x, unnest(range(parts)) AS g(j)),
v AS (SELECT doc_id, src, (SELECT count(*) FROM t WHERE t.src = u.src AND t.c <= u.u) AS one FROM u),
n AS (SELECT doc_id, sum(one)::INTEGER AS n_copies FROM v GROUP BY doc_id),
e AS (SELECT x.*, n_copies, unnest(range(n_copies))::INTEGER AS copy FROM x JOIN n USING (doc_id))
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, n_copies, copy,
       ('0x' || substr(md5('{SEED}-order|' || key || '|' || copy), 1, 15))::BIGINT AS mix_key FROM e
"""
