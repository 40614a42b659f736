"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOW33 = (1 << 33) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path in the shared folder that the session names for checkpoints.

    Only where neither the session nor the context names one is a temporary
    folder set, and only on a local master: on a cluster each machine would write
    to its own disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="isohyet-checkpoint-"))
    return f"{sc.getCheckpointDir()}/{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder that the session names.

    Old checkpoints go with their DataFrames where the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def global_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number all rows from 0 in the order of ``order``, without one task for all.

    The rows are dealt by range and sorted in each partition; the checkpoint
    pins that layout, so that the offsets (one count per partition, a bound set
    by the number of shuffle partitions) belong to the same rows.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    dealt = checkpoint(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).cast("int")
    counts = dealt.groupBy(part.alias("_part")).count().collect()
    offsets, seen = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], seen))
        seen += row["count"]
    small = spark.createDataFrame(offsets, "_part int, _offset long")
    return (
        dealt.withColumn("_part", part)
        .join(F.broadcast(small), "_part")
        .withColumn(name, F.col("_offset") + F.col("_at").bitwiseAND(F.lit(LOW33)))
        .drop("_at", "_part", "_offset")
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Views of few rows and few bytes, so that only so much text is Python objects at once; a longer row comes alone."""
    for batch in batches:
        long = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                long += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        end = np.cumsum(long)
        at = 0
        while at < batch.num_rows:
            held = end[at - 1] if at else 0
            stop = min(at + rows, max(at + 1, int(np.searchsorted(end, held + size, side="right"))))
            yield batch.slice(at, stop - at)
            at = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
