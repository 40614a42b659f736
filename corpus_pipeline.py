"""The corpus pipeline: five stages over documents, each written and read again.

Every stage works on all rows that the one before it kept and returns the columns
of documents (the last adds its row_number, shard and slot); other columns of its
input are dropped, whatever their names.  Empty tables give no rows, texts of any
length are read whole, and rows that repeat are rows each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import cotraining, decontaminate, mixing, sharding, simhash
from isohyet.llm.common import checkpoint, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects, those without words among them; rows without doc_id have no label."""
    docs = docs.select(*COLUMNS)
    model = cotraining.train(docs, table(spark, sf_dir, "labels"))
    return cotraining.score_documents(docs, model, list(COLUMNS)).filter("keep").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near copies.

    Texts without words are one group; different texts under one doc_id, or under
    none, stay unless they are near copies; of a row that repeats one stays.
    """
    return simhash.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a window of a benchmark item occurs; null texts have no words and stay."""
    docs = docs.select(*COLUMNS)
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that all sources, null being one, come to weigh the same, in shuffled order."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds row_number, shard and slot by the Feistel permutation; null doc_ids come first."""
    docs = docs.select(*COLUMNS)
    return sharding.shard_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, cut by a checkpoint after each."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir).withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))


#: The classifier's scores have no SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None
