"""Mixing sources to target weights by Poisson replication, in SQL functions only.

Each source has a mean repetition rate: target share x epochs x all bytes /
bytes of the source.  A document's count inverts the Poisson distribution of
that mean at a uniform number made from md5(seed, doc_id), so it is the same on
every run and under every partitioning.  Rates above ``MAX_MEAN`` are drawn as
the sum of several Poisson parts, which has the same distribution and never
underflows.  Copies are then dealt to partitions, and sorted in them, by a hash.
Where a rate is so high that one document has more than ``CHUNK`` copies, runs of
so many are dealt to partitions first and copied there, so that no task makes all
copies of a document.

Defined cases: a null source is a source of its own; null texts weigh nothing
but take part; a source without bytes has rate 0 unless all are empty; sources
without a target weight get none when weights are given, else all weigh the
same; repeated rows with one doc_id get the same count; empty tables give no rows;
texts of any length are carried whole; other columns go along, save those whose
names this operator adds (copy, n_copies, rate, shuffle_key), which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_MEAN = 64.0
#: Up to so many sources the rates are broadcast (some MB); beyond, both sides are salted and shuffled.
BROADCAST_SOURCES = 20_000
SALTS = 64
CHUNK = 1024
TWO_52 = 4503599627370496.0


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the md5 of the parts joined by |."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(TWO_52)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """One row per source: _mix_source, _mix_rate, _mix_draws, and _mix_cdf, the cumulative Poisson probabilities of one draw."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("double").alias("bytes"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "_mix_source string, weight double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source").na.fill({"weight": 0.0})
    total = sizes.agg(F.sum("bytes").alias("b"), F.sum("weight").alias("w")).first()
    all_bytes, all_weights = total["b"] or 0.0, total["w"] or 1.0
    rate = F.when(F.col("bytes") > 0, F.col("weight") / F.lit(all_weights) * F.lit(epochs * all_bytes) / F.col("bytes")).otherwise(F.lit(0.0 if all_bytes else float(epochs)))
    mean = F.col("rate") / F.col("draws")
    first = F.exp(-mean)
    step = lambda s, k: F.struct(
        (s["p"] * mean / k).alias("p"),
        (s["c"] + s["p"] * mean / k).alias("c"),
        F.concat(s["cdf"], F.array(s["c"] + s["p"] * mean / k)).alias("cdf"),
    )
    last = F.ceil(mean + 10.0 * F.sqrt(mean) + 20.0).cast("int")
    cdf = F.aggregate(F.sequence(F.lit(1), last), F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf")), step, lambda s: s["cdf"])
    return (
        sizes.withColumn("rate", rate)
        .withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(MAX_MEAN))).cast("int"))
        .withColumn("cdf", cdf)
        .select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"), F.col("draws").alias("_mix_draws"), F.col("cdf").alias("_mix_cdf"))
    )


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: int = 20) -> DataFrame:
    """Every column of docs, with copy (from 1), n_copies, rate and shuffle_key, in shuffled order."""
    docs = docs.drop("copy", "n_copies", "rate", "shuffle_key")
    rates = source_rates(docs, weights, epochs)
    facts = rates.agg(F.count(F.lit(1)).alias("n"), F.max("_mix_rate").alias("top")).first()
    if facts["n"] <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("_mix_source")))
    else:
        salted = rates.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        joined = docs.withColumn("_mix_salt_of", salt).join(salted, F.col("source").eqNullSafe(F.col("_mix_source")) & (F.col("_mix_salt_of") == F.col("_mix_salt"))).drop("_mix_salt", "_mix_salt_of")
    one = lambda j: F.size(F.filter(F.col("_mix_cdf"), lambda c: c <= uniform(F.lit(seed), F.col("doc_id"), j)))
    # The common single draw takes the bare expression, which leaves the lambda over draws out of the plan's hot path.
    several = F.aggregate(F.sequence(F.lit(1), F.col("_mix_draws")), F.lit(0), lambda n, j: n + one(j))
    drawn = joined.withColumn("n_copies", F.when(F.col("_mix_draws") == 1, _count(seed)).otherwise(several)).filter("n_copies > 0").withColumnRenamed("_mix_rate", "rate").drop("_mix_source", "_mix_draws", "_mix_cdf")
    if (facts["top"] or 0.0) * 2 > CHUNK:
        runs = drawn.withColumn("_mix_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_copies") - 1) / CHUNK).cast("int"))))
        dealt = runs.repartition(F.xxhash64("doc_id", "text", "_mix_run"))
        first = F.col("_mix_run") * CHUNK
        copies = dealt.withColumn("copy", F.explode(F.sequence(first + 1, F.least(first + CHUNK, F.col("n_copies"))))).drop("_mix_run")
    else:
        copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _count(seed: int) -> Column:
    u = uniform(F.lit(seed), F.col("doc_id"), F.lit(1))
    return F.aggregate(F.col("_mix_cdf"), F.struct(F.lit(0).alias("n"), u.alias("u")), lambda s, c: F.struct((s["n"] + F.when(c <= s["u"], 1).otherwise(0)).alias("n"), s["u"].alias("u")), lambda s: s["n"])


#: The same rows in DuckDB, for equal weights, one epoch and seed 20.
ORACLE_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(octet_length(encode(text)), 0)) AS DOUBLE) AS bytes FROM documents GROUP BY source),
rates AS (
  SELECT source, 1e0 / (SELECT CAST(count(*) AS DOUBLE) FROM sizes) * (1e0 * (SELECT sum(bytes) FROM sizes)) / bytes AS rate FROM sizes),
parts AS (SELECT source, rate, CAST(greatest(1, ceil(rate / 64e0)) AS INT) AS draws FROM rates),
cdf AS (
  SELECT source, 0 AS k, exp(-(rate / draws)) AS p, exp(-(rate / draws)) AS c, rate / draws AS mean,
         CAST(ceil(rate / draws + 10e0 * sqrt(rate / draws) + 20e0) AS INT) AS last FROM parts
  UNION ALL
  SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean, last FROM cdf WHERE k < last),
lists AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, p.rate, CAST(list_sum(list_transform(generate_series(1, p.draws), lambda j:
         len(list_filter(l.cs, lambda c: c <= CAST(CAST('0x' || substr(md5('20|' || d.doc_id || '|' || j), 1, 13) AS UBIGINT) AS DOUBLE) / 4503599627370496e0)))) AS INT) AS n_copies
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source JOIN lists l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, text, lang, source, n_chars, n_copies, round(rate, 9) AS rate, CAST(unnest(generate_series(1, n_copies)) AS INT) AS copy,
       md5('order20|' || doc_id || '|' || unnest(generate_series(1, n_copies))) AS shuffle_key
FROM drawn WHERE n_copies > 0
"""
