"""Sharding by a Feistel permutation over global row numbers (law: rows).

Every row gets its rank in the order (doc_id, text checksum, size).  A balanced
Feistel network over the smallest even number of bits that holds the row count,
walked along its cycle until the value falls below the count, permutes the
ranks; the permuted rank modulo the shard count is the shard and the quotient is
the slot.  Both directions are computable: ``locate`` from a rank, ``rank_at``
from a shard and slot, without any table.

Defined cases: a null text has size 16 and checksum 0; null doc_ids come first;
repeated rows get ranks of their own, in an order that equal digests cannot
tell apart; an empty table gives no rows; other columns are not read, and
``shard_rows`` carries them, save those named row_number, shard and slot, which it
replaces.  A key of any number of rows is dealt over many partitions.
Equal texts are spread like any other rows, as the row law asks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import global_row_number, mix64

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _keys(seed: int) -> np.ndarray:
    return mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _network(x: np.ndarray, n: int, seed: int, inverse: bool) -> np.ndarray:
    half = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(half)) - 1)
    left, right = x >> half, x & mask
    keys = _keys(seed)
    for key in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (mix64(left + key) & mask), left
        else:
            left, right = right, left ^ (mix64(right + key) & mask)
    return (left << half) | right


def permute(x: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """A permutation of 0..n-1: values at or beyond n walk on along their cycle."""
    out = _network(np.asarray(x, dtype=np.uint64), n, seed, inverse)
    while (far := out >= np.uint64(n)).any():
        out[far] = _network(out[far], n, seed, inverse)
    return out


def locate(rank: np.ndarray, n: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers."""
    at = permute(rank, n, seed)
    return at % np.uint64(shards), at // np.uint64(shards)


def rank_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = 0) -> np.ndarray:
    """The global row number that lies in a slot of a shard."""
    at = np.asarray(slot, dtype=np.uint64) * np.uint64(shards) + np.asarray(shard, dtype=np.uint64)
    return permute(at, n, seed, inverse=True)


def assign_shards(rows: DataFrame, order: list[str], shards: int = 40, seed: int = 0) -> DataFrame:
    """Add row_number, shard and slot to rows, which should be light (no texts)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    ranked = global_row_number(rows, order, "row_number")
    n = ranked.count()

    @F.pandas_udf("struct<shard:int,slot:bigint>")
    def deal(rank: pd.Series) -> pd.DataFrame:
        shard, slot = locate(rank.to_numpy(), n, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot.astype(np.int64)})

    # Only row numbers go to Python; the other columns stay where they are.
    return ranked.withColumn("_place", deal("row_number")).select(*ranked.columns, "_place.shard", "_place.slot")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32: all that the order of rows needs."""
    return docs.select("doc_id", *[made.alias(name) for name, made in _digests().items()])


def _digests() -> dict[str, Column]:
    return {"size": (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long"), "text_crc32": F.crc32(F.coalesce("text", F.lit("")))}


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Rows of one key are told apart by a random number as in ``shard_rows``, so that
    a key of any number of rows is dealt over many partitions.
    """
    dealt = assign_shards(digest(docs).withColumn("_salt", F.rand(seed)), ["doc_id", "text_crc32", "size", "_salt"], shards, seed)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """All columns of docs with row_number, shard and slot, the same places as by ``shard_documents``.

    The whole rows are dealt by range of their keys once and numbered where they
    lie; rows of one key are told apart by a random number, which the numbering's
    checkpoint pins, so that they spread over many partitions.
    """
    docs = docs.drop("row_number", "shard", "slot")
    names = {"size": "_shard_size", "text_crc32": "_shard_crc"}
    keyed = docs.withColumns({names[name]: made for name, made in _digests().items()} | {"_shard_salt": F.rand(seed)})
    dealt = assign_shards(keyed, ["doc_id", "_shard_crc", "_shard_size", "_shard_salt"], shards, seed)
    return dealt.drop("_shard_crc", "_shard_size", "_shard_salt")
