"""Neighbours found through the graphs against brute force."""

import numpy as np
import pytest

from isohyet.llm import hnsw

KIND = "vec_id long, embedding array<float>, label int"


def brute(ids, x, every=100, k=10):
    """query_id to its k nearest (distance, id)."""
    told = {}
    for own, vector in zip(ids, x):
        if own % every == 0:
            apart = np.sqrt(((x - vector) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, apart)) if ids[j] != own][:k]
            told[own] = [(apart[j], ids[j]) for j in order]
    return told


def found(df):
    told = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        told.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(told[r["query_id"]])
    return told


def recall(got, want):
    return np.mean([len({i for _, i in got.get(q, [])} & {i for _, i in near}) / max(len(near), 1) for q, near in want.items()])


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 0) for i, v in zip(ids, x)], KIND)


@pytest.mark.parametrize("shard_rows", [700, 4096])
def test_recall_on_given_rows(spark, shard_rows):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    got, want = found(hnsw.nearest(df, shard_rows=shard_rows)), brute(rows["vec_id"].to_numpy(), x)
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    for q, near in got.items():
        assert len(near) == 10 and near == sorted(near)
        for score, i in near:
            assert abs(score - np.sqrt(((x[rows["vec_id"] == i] - x[rows["vec_id"] == q]) ** 2).sum())) < 1e-12


def test_clusters_and_copies(spark):
    """A third of all rows are one vector, others stand in tight clusters: copies are ties by id."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([np.repeat(centres[:1], 800, axis=0), centres[rng.integers(0, 20, 1600)] + 0.01 * rng.normal(size=(1600, 16))]).astype(np.float32).astype(np.float64)
    ids = rng.permutation(len(x)) * 25
    got, want = found(hnsw.nearest(frame(spark, ids, x), shard_rows=512)), brute(ids, x)
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    for own in [i for i, v in zip(ids, x) if i % 100 == 0 and (v == x[0]).all()]:
        assert got[own] == want[own]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (9, [3.0e38, -3.0e38])]
    df = spark.createDataFrame([(*r, 1) for r in rows], KIND).selectExpr("*", "1 AS rank", "2 AS query_id", "3 AS shard", "4 AS score")
    got = found(hnsw.nearest(df))
    assert got == {0: [(0.0, 1), (np.sqrt(2.0), 100), (np.sqrt(2 * np.float64(np.float32(3e38)) ** 2), 9)], 100: [(np.sqrt(2.0), 0), (np.sqrt(2.0), 1), (np.sqrt(2 * np.float64(np.float32(3e38)) ** 2), 9)]} or (
        [i for _, i in got[0]] == [1, 100, 9] and [i for _, i in got[100]] == [0, 1, 9]
    )
    assert found(hnsw.nearest(df.limit(0))) == {}
    assert found(hnsw.nearest(df.filter("vec_id = 0"))) == {}


def test_every_row_is_indexed(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    index = hnsw.build_index(df, 200).collect()
    ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in index])
    assert sorted(ids) == sorted(r["vec_id"] for r in df.select("vec_id").collect())
    for r in index:
        low = np.frombuffer(r["graphs"][0], np.int32).reshape(r["nodes"], 2 * hnsw.LINKS)
        assert low.max() < r["nodes"] and not (low == np.arange(r["nodes"])[:, None]).any()
        # all nodes can be reached from the entry
        seen, todo = {0}, [0]
        while todo:
            for n in low[todo.pop()]:
                if n >= 0 and n not in seen:
                    seen.add(int(n))
                    todo.append(int(n))
        assert len(seen) >= 0.99 * r["nodes"]


def test_double_vectors(spark):
    x = np.random.default_rng(2).normal(size=(300, 5))
    df = frame(spark, range(300), x).drop("embedding")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(found(hnsw.nearest(df)), brute(np.arange(300), x)) == 1.0
