"""Connected components over an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum((F.xxhash64("v", "u") % 1_000_003)).alias("s")).first()
    return row["n"], row["x"], row["s"]


#: Rows of an edge table in a partition, so that shrinking tables don't keep their many partitions.
ROWS = 200_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the least node reachable) for every node that has an edge.

    Large stars link each node's larger neighbours to its least neighbour, small
    stars its smaller ones; rounds repeat until nothing changes, which takes a
    number of rounds that grows with the logarithm of the longest chain.  Each
    step is an aggregation, which combines before the shuffle, and a join whose
    one side has a row per node, so that a hub can be split between tasks.
    Edges with a null node are not read.
    """
    greater, less = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = checkpoint(edges.filter(F.col(a) != F.col(b)).select(greater, less).distinct())
    state = _state(now)
    while state[0]:
        now = now.coalesce(max(8, -(-state[0] // ROWS)))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = checkpoint(small)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
