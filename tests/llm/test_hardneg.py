"""Hard negatives against brute force, the curve, and what the bounds exclude."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.llm import hardneg

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    """Plain loops over rows (vec_id, vector, label)."""
    held = []
    for i, v, label in dict.fromkeys((i, tuple(v) if v is not None else None, label) for i, v, label in rows):
        if i is None or v is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    told = []
    for i, label, v in held:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in held if j != i and len(w) == len(v)))
        for p, j, _ in [x for x in scored if x[2] == label][:5]:
            found = [(-s, k) for s, k, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            told += [(i, j, rank, k, -p, s) for rank, (s, k) in enumerate(found, 1)]
    return sorted(told)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def mine(df, **more):
    return hardneg.mine(df, hardneg.shifted_label(), **more)


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "anchors": 3, "group": 2, "bits": 2}])
def test_equals_brute_force(spark, sizes):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert got(mine(df, **sizes)) == want and len(want) > 100


def test_equals_sql(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    assert got(mine(df)) == sorted(con.sql(hardneg.ORACLE_SQL).fetchall())


def test_copies_and_ties(spark):
    """A third of all rows are one vector under two labels; others have few different scores."""
    rng = np.random.default_rng(4)
    rows = [(int(i), [1.0, 0.5, 0.25], int(i % 2)) for i in range(0, 300)]
    rows += [(int(i), [float(x) for x in rng.integers(0, 3, 3)], int(rng.integers(0, 3))) for i in range(300, 900)]
    rows += rows[:100]
    assert got(mine(spark.createDataFrame(rows, KIND).repartition(7), block=64, anchors=8, group=3)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.5, 0.75], 2), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (None, [1.0, 1.0], 2), (8, [1.0, 1.0], None), (9, [], 1)]
    rows += [(50, [0.0, 0.0], 1), (51, [0.0, 0.0], 2), (52, [-1.0, 0.0], 1), (100, [1.0, 1.0, 1.0], 3), (101, [1.0, 1.0, 0.5], 3), (102, [0.5, 0.5, 1.0], 4), (50, [1.0, 0.25], 2), (50, [1.0, 0.25], 2)]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS block", "2 AS segment", "3 AS ablock", "4 AS rank", "'x' AS _dim")
    want = brute(rows)
    assert got(mine(df)) == want and want
    assert got(mine(df.limit(0))) == []
    assert got(mine(df.filter("vec_id = 0"))) == []


def test_double_vectors_and_large_scores(spark):
    x = np.random.default_rng(2).normal(size=(200, 4)) * 1000
    x = x.astype(np.float32).astype(np.float64)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    assert got(mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=32)) == brute(rows)
    with pytest.raises(Exception, match="2\\^53"):
        mine(spark.createDataFrame([(0, [3e30, 1.0], 1), (1, [3e30, 2.0], 1)], KIND)).collect()


def test_hilbert_order_is_a_walk():
    """All cells of a cube once, each a step from the one before."""
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hardneg.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[np.array(sorted(range(len(cells)), key=keys.__getitem__))]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    a, x = hardneg.whole(rng.normal(size=(20, 6))), hardneg.whole(rng.normal(size=(50, 6)))
    held = hardneg._Anchors({"ids": np.arange(20).tobytes(), "labels": np.zeros(20, np.int64).tobytes(), "least": np.zeros(20).tobytes(), "vectors": a.tobytes()})
    least, most = held.bounds(x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (least[:, 0] <= score.min(axis=1)).all() and (score.max(axis=1) <= most[:, 0]).all()


def test_clustered_rows_leave_most_blocks_unread(spark, tmp_path):
    """Where vectors stand in clusters, bounds exclude most pairs of blocks, and results stay whole."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(16, 8))
    centres = 4 * centres / np.linalg.norm(centres, axis=1)[:, None]
    rows = [(int(i), [float(np.float32(c)) for c in centres[i % 16] + 0.02 * rng.normal(size=8)], int(i * 7919 // 16 % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, KIND)
    hardneg.write_blocks(hardneg.usable(df, hardneg.shifted_label()), f"{tmp_path}/blocks", 50, 32)
    blocks = spark.read.parquet(f"{tmp_path}/blocks")
    assert blocks.agg(F.sum("rows")).first()[0] == 3000
    held = hardneg._anchor_blocks(blocks, 4)
    chosen = hardneg._choose(held, blocks.select("_dim", "segment", "block", "low", "high", "kinds"), False).count()
    assert chosen < 0.4 * held.count() * blocks.count()
    assert got(mine(df, block=32, anchors=4, path=f"{tmp_path}/again")) == brute(rows)


def test_zone_maps_are_read_alone(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    hardneg.write_blocks(hardneg.usable(df, F.col("label")), f"{tmp_path}/blocks", 50, 64)
    zones = spark.read.parquet(f"{tmp_path}/blocks").filter(F.col("segment").isin([0])).select("block", "low", "high")
    plan = zones._jdf.queryExecution().executedPlan().toString()
    assert "vectors" not in plan.split("ReadSchema")[1].split("\n")[0] and "PartitionFilters: [isnotnull(segment" in plan or "segment" in plan.split("PartitionFilters")[1]
