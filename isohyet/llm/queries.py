"""The thin queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import chat, cotraining, decontaminate, hardneg, hnsw, mixing, ppm, sharding, simhash, spelling, spotsigs, substrings, tagpaths
from isohyet.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.identify_languages(table(spark, sf_dir, "documents"))


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extract(table(spark, sf_dir, "pages"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "text", "lang", "source", "n_chars", "n_copies", F.round("rate", 9).alias("rate"), "copy", "shuffle_key")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(table(spark, sf_dir, "conversations"))


def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(table(spark, sf_dir, "embeddings"), hardneg.shifted_label())


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {
        "op4_substring_dedup": substrings.ORACLE_SQL,
        "op5_poisson_mixing": mixing.ORACLE_SQL,
        "op7_decontamination": decontaminate.ORACLE_SQL,
        "op8_chat_formatting": chat.ORACLE_SQL,
        "op11_hard_negatives": hardneg.ORACLE_SQL,
        "op12_spelling_variants": spelling.ORACLE_SQL,
    }
