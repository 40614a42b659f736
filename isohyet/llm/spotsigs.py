"""SpotSigs document fingerprints, in SQL functions only.

A spot signature is an anchor (a common function word) and the chain of the next
content words after it; the fingerprint is the set of hashed signatures.  Two
fingerprints are alike by their Jaccard measure.  ``near_duplicates`` compares
only sets whose lengths allow the threshold: sets are partitioned by length, the
partition bounds follow from the threshold, and inside neighbouring partitions
only sets that share one of their rarest signatures meet.  Equal sets count once;
many sets that share a rare signature cost up to the square of their number.

Defined cases: a null text is empty and has the empty fingerprint; two empty
fingerprints are alike 1, an empty and a full one 0; a text without any anchor
takes every word as one; a chain that the text's end cuts short is kept short;
equal doc_ids are in the order of a hash of their texts, rows without doc_id come
last; repeated rows stay; texts of any length are read whole; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm.common import shuffle_partitions
from isohyet.llm.graph import connected_components

# Common function words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that it was for with as are on be at by this from or an he which not but they have had his her were there been their "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es werden aus er hat dass sie nach wird bei "
    "de la le les et du une un que qui dans pour sur pas plus par au avec est ce il elle ne se en des "
    "el los las del por con no una su para al lo como más pero sus ya y o a"
).split()
CHAIN = 2
#: Quantiles of doc_id that the ranges follow, and ranges for each shuffle partition.
SPLITS, RANGES = 256, 8


def signatures(text: Column, chain: int = CHAIN, anchors: list[str] | None = None) -> Column:
    """The sorted set of hashed spot signatures, array<bigint>."""
    common = sorted(set(anchors or ANCHORS))
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    spots = lambda w: F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), i).otherwise(F.lit(-1))), lambda i: i >= 0)
    hashed = lambda s: F.transform(
        s["spots"], lambda i, j: F.xxhash64(F.get(s["words"], i), F.array_join(F.slice(s["content"], i - j + 1, F.lit(chain)), " "))
    )
    every = lambda s: F.transform(s["words"], lambda x, i: F.xxhash64(x, F.array_join(F.slice(s["words"], i + 2, F.lit(chain)), " ")))
    held = F.transform(F.array(words), lambda w: F.struct(w.alias("words"), spots(w).alias("spots"), F.filter(w, lambda x: ~x.isin(common)).alias("content")))
    found = F.transform(held, lambda s: F.when(F.size(s["spots"]) > 0, hashed(s)).otherwise(every(s)))
    return F.array_sort(F.array_distinct(F.get(found, F.lit(0))))


def as_string(sigs: Column) -> Column:
    """A fingerprint as text: its signatures in hex, in order, joined by commas."""
    return F.array_join(F.transform(sigs, lambda h: F.lower(F.hex(h))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard measure of two signature sets."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def length_partition(sigs: Column, threshold: float = 0.8) -> Column:
    """Sets in partitions further apart than one can't reach the threshold: bounds grow by its inverse."""
    return F.when(F.size(sigs) == 0, F.lit(-1)).otherwise(F.floor(F.log(F.size(sigs).cast("double")) / F.log(F.lit(1.0 / threshold)) + F.lit(1e-9)).cast("int"))


def near_duplicates(prints: DataFrame, id_column: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """One row per document: its id, class_id (the least id of documents that a chain of alike sets reaches, itself included)
    and n_links, the number of other different sets that its own is alike to."""
    pairs = alike_sets(prints, id_column, threshold)
    found = connected_components(pairs.select("id_a", "id_b"), "id_a", "id_b")
    links = pairs.select(F.col("id_a").alias("set_id")).unionByName(pairs.select(F.col("id_b").alias("set_id"))).groupBy("set_id").agg(F.count(F.lit(1)).alias("n_links"))
    sets = prints.groupBy("sigs").agg(F.min(id_column).alias("set_id")).join(links, "set_id", "left").join(found.withColumnRenamed("node", "set_id"), "set_id", "left")
    told = sets.select("sigs", F.coalesce("component", "set_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return prints.join(told, "sigs").select(id_column, "class_id", "n_links")


def alike_sets(prints: DataFrame, id_column: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """Pairs (id_a < id_b, jaccard) of different signature sets, between one representative of each set.

    ``prints`` has the id and ``sigs``.  Equal sets collapse to their least id
    first.  Each set is indexed by its rarest signatures, as many as every set
    alike to the threshold must share one of (prefix filtering by document
    frequency), under its length partition and the one below.
    """
    sets = prints.filter(F.size("sigs") > 0).groupBy("sigs").agg(F.min(id_column).alias("id"))
    each = sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    rare = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = each.join(rare, "sig", "left").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "sig"))).alias("o"))
    keep = (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int")
    part = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.0 / threshold)) + F.lit(1e-9)).cast("int")
    keyed = ordered.select("id", "n", part.alias("part"), F.explode(F.slice("o", F.lit(1), keep)).alias("k")).filter("k.df > 1").select("id", "n", "part", F.col("k.sig").alias("sig"))
    left = keyed.select(F.col("id").alias("id_a"), F.col("n").alias("n_a"), "sig", "part")
    right = keyed.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), "sig", F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part"))
    fits = (F.col("id_a") < F.col("id_b")) & (F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9)
    pairs = left.join(right, ["sig", "part"]).filter(fits).select("id_a", "id_b").distinct()
    a, b = sets.select(F.col("id").alias("id_a"), F.col("sigs").alias("_a")), sets.select(F.col("id").alias("id_b"), F.col("sigs").alias("_b"))
    return pairs.join(a, "id_a").join(b, "id_b").withColumn("jaccard", likeness(F.col("_a"), F.col("_b"))).filter(F.col("jaccard") >= threshold - 1e-9).select("id_a", "id_b", "jaccard")


def _buckets(docs: DataFrame, buckets: int) -> Column:
    """A number of about ``buckets`` that never falls as doc_id grows; nulls have the least.

    Ranges between quantiles of all doc_ids are cut evenly; a doc_id that is a
    quantile more than once, and the rows without one, are cut by the texts' hash.
    """
    quantiles = F.percentile_approx("doc_id", [i / SPLITS for i in range(SPLITS + 1)], 100_000)
    at = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"), quantiles.alias("q"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    parts = lambda rows: max(1, round(buckets * rows / max(1, at["n"])))
    none = parts(at["n"] - at["ids"])
    by_hash = lambda n: F.floor(F.pmod(F.col("_h"), F.lit(1 << 30)).cast("double") / (1 << 30) * n)
    if not at["ids"]:
        return by_hash(F.lit(none)).cast("int")
    held = [at["lo"], *at["q"], at["hi"]]
    heavy = {v for v, n in Counter(held[1:-1]).items() if n > 2}
    cuts = sorted({*held, *heavy, *[v + 1 for v in heavy], at["hi"] + 1})
    counts = [parts(at["ids"] * sum(low <= v < high for v in held[1:-1]) / (SPLITS + 1)) for low, high in pairwise(cuts)]
    first = [none + sum(counts[:k]) for k in range(len(counts))]
    table = F.array(*[
        F.struct(F.lit(low).cast("double").alias("low"), F.lit(float(high) - float(low)).alias("wide"), F.lit(n).alias("n"), F.lit(at_).alias("first"), F.lit(low in heavy).alias("heavy"))
        for (low, high), n, at_ in zip(pairwise(cuts), counts, first, strict=True)
    ])
    lows = F.array(*[F.lit(int(c)) for c in cuts[:-1]])
    of = F.get(table, F.size(F.filter(lows, lambda c: c <= F.col("doc_id"))) - 1)
    inside = lambda s: F.when(s["heavy"], by_hash(s["n"])).otherwise(F.floor((F.col("doc_id").cast("double") - s["low"]) / s["wide"] * s["n"]))
    number = F.get(F.transform(F.array(of), lambda s: s["first"] + F.greatest(F.lit(0), F.least(inside(s), s["n"] - 1))), F.lit(0))
    return F.when(F.col("doc_id").isNull(), by_hash(F.lit(none))).otherwise(number).cast("int")


def with_next(docs: DataFrame, buckets: int | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """Each document with the one after it in descending doc_id as struct ``next`` (text and ``more``); the first follows the last.

    Documents are dealt by ranges of doc_id, some for each shuffle partition, and
    the first rows of each range go to the range before as well, so the texts are
    shuffled once and no task sees more than its ranges.
    """
    placed = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    placed = placed.withColumn("_h", F.xxhash64("text"))
    placed = placed.withColumn("_bucket", _buckets(placed, buckets or RANGES * shuffle_partitions(docs.sparkSession)))
    # Without nulls and ascending: the complement of a doc_id falls as it grows.
    order = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"), F.col("_h").alias("h")]
    first = placed.groupBy("_bucket").agg(F.min(F.struct(*order)).alias("top")).collect()
    first.sort(key=lambda r: tuple(r["top"]))
    halo = [(r["_bucket"], *r["top"], first[i - 1]["_bucket"]) for i, r in enumerate(first)]
    tops = docs.sparkSession.createDataFrame(halo, "_bucket int, _none boolean, _down long, _top long, _before int")
    here, there = (F.struct(F.col(name).alias("b"), F.lit(k).alias("halo")) for k, name in enumerate(("_bucket", "_before")))
    at_top = (order[0] == F.col("_none")) & (order[1] == F.col("_down")) & (F.col("_h") == F.col("_top"))
    sent = placed.join(F.broadcast(tops), "_bucket", "left").withColumn("_to", F.explode(F.when(at_top, F.array(here, there)).otherwise(F.array(here))))
    dealt = sent.select("doc_id", "text", "_h", F.col("_to.b").alias("_b"), F.col("_to.halo").alias("_halo")).repartition("_b")
    for name, made in (more or {}).items():
        dealt = dealt.withColumn(name, made)
    held = Window.partitionBy("_b").orderBy("_halo", F.desc_nulls_last("doc_id"), "_h", "text")
    following = F.lead(F.struct("text", *(more or {}))).over(held)
    return dealt.withColumn("next", following).filter("_halo = 0").drop("_b", "_halo", "_h")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures, length_partition."""
    ahead = with_next(docs, more={"sigs": signatures(F.col("text"))})
    third = F.floor(F.char_length("text") / F.lit(3)).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - third), F.substring(F.col("next.text"), F.lit(1), third))
    told = ahead.withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return told.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("sigs")).alias("fingerprint"),
        as_string(F.col("edited_sigs")).alias("edited_fingerprint"), likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next.sigs")).alias("near_next"), F.size("sigs").alias("n_signatures"), length_partition(F.col("sigs")).alias("length_partition"),
    )
