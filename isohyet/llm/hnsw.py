"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, and shard results merged.

Rows are dealt to shards of about SHARD rows by a hash of id and vector, so equal
vectors of many ids spread over all shards; in a shard, equal vectors are one node
with all its ids.  Every row is in an index.  A graph is flat arrays: nodes stand in
the order of falling level, so the graph of a level is an array of neighbour numbers
over the first nodes of that order.

Graphs are built level by level from the top, in batches that at most double what is
there: a batch searches the graph so far, its members see each other, and links go
both ways through the choice of diverse neighbours.  Searches run in lockstep over
all queries of a block: each step opens every query's nearest open node.

Queries come in blocks, and each block meets every shard: the work is queries times
shards, which is what merging the results of all shards asks for.  A task holds one
shard and at most GROUP blocks of queries.

Rows whose vec_id or vector is null, whose vector is empty, zero, or holds null or
non-finite components take no part.  Rows that repeat count once; different vectors
under one vec_id are rows each, but never a neighbour of that vec_id.  Vectors of
different lengths do not meet.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint, mix64, shuffle_partitions

#: Links of a node above the lowest level (twice as many there), and nodes kept while building and while searching.
LINKS, EF_BUILD, EF = 16, 96, 192
SHARD, BLOCK, GROUP, BATCH = 4096, 512, 16, 512
LARGEST = 1.7976931348623157e308


def usable(df: DataFrame) -> DataFrame:
    """vec_id, embedding and _dim of the rows that take part, each once."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & (x >= -LARGEST) & (x <= LARGEST)) & F.exists("embedding", lambda x: x != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & fine).withColumn("_dim", F.size("embedding"))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of a (rows, d) to its own rows of b (rows, m, d)."""
    gap = b - a[:, None, :]
    return np.einsum("rmd,rmd->rm", gap, gap)


def beam(x: np.ndarray, links: np.ndarray, asked: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ef nearest nodes found for each asked vector, nearest first (-1 and inf where fewer are met), walking links from the entry nodes."""
    many, nodes = len(asked), len(links)
    seen = np.zeros((many, nodes + 1), bool)
    held = np.full((many, ef), -1, np.int32)
    far = np.full((many, ef), np.inf, np.float32)
    shut = np.ones((many, ef), bool)
    every = np.arange(many)

    def take(rows: np.ndarray, found: np.ndarray) -> None:
        new = (found >= 0) & ~seen[rows[:, None], found]
        seen[rows[:, None], found] = True
        seen[:, nodes] = False
        gap = np.where(new, _apart(asked[rows], x[found]), np.inf).astype(np.float32)
        better = np.flatnonzero((gap < far[rows, -1:]).any(axis=1))
        rows, found, gap = rows[better], found[better], gap[better]
        told = np.concatenate([far[rows], gap], axis=1)
        order = np.argsort(told, axis=1, kind="stable")[:, :ef]
        far[rows] = np.take_along_axis(told, order, 1)
        held[rows] = np.take_along_axis(np.concatenate([held[rows], found.astype(np.int32)], axis=1), order, 1)
        shut[rows] = np.take_along_axis(np.concatenate([shut[rows], ~np.isfinite(gap)], axis=1), order, 1)

    for k in range(entry.shape[1]):
        take(every, entry[:, k : k + 1])
    while True:
        near = np.where(shut, np.inf, far)
        at = near.argmin(axis=1)
        rows = np.flatnonzero(np.isfinite(near[every, at]))
        if not len(rows):
            return np.where(np.isfinite(far), held, -1), far
        shut[rows, at[rows]] = True
        take(rows, links[held[rows, at[rows]]])


def diverse(x: np.ndarray, found: np.ndarray, gap: np.ndarray, width: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the node than to any chosen before; free places go to the nearest others."""
    many = found.shape[1]
    v = x[found]
    size = np.einsum("rmd,rmd->rm", v, v)
    between = size[:, :, None] + size[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    real = np.isfinite(gap)
    chosen, least, full = np.zeros(found.shape, bool), np.full(found.shape, np.inf, np.float32), np.zeros(len(found), np.int32)
    for k in range(many):
        fit = real[:, k] & (gap[:, k] < least[:, k]) & (full < width)
        chosen[:, k] = fit
        full += fit
        np.minimum(least, between[:, k], out=least, where=fit[:, None])
    place = np.arange(many) + np.where(chosen, 0, np.where(real, many, 2 * many))
    order = np.argsort(place, axis=1)[:, :width]
    kept = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(found, order, 1), -1)
    return kept if many >= width else np.pad(kept, ((0, 0), (0, width - many)), constant_values=-1)


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Give the targets of the new nodes' links a link back, and choose anew where there are too many."""
    width = links.shape[1]
    source = np.repeat(new, width)
    target = links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    gap = ((x[source] - x[target]) ** 2).sum(axis=1)
    order = np.lexsort((gap, target))
    source, target = source[order], target[order]
    nodes, start, size = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(start, size)
    near = place < width
    told = np.full((len(nodes), width), -1, np.int64)
    told[np.repeat(np.arange(len(nodes)), size)[near], place[near]] = source[near]
    old = links[nodes]
    told[(told[:, :, None] == old[:, None, :]).any(axis=2)] = -1
    for k in range(0, len(nodes), BATCH):
        own, both = nodes[k : k + BATCH], np.concatenate([old[k : k + BATCH], told[k : k + BATCH]], axis=1)
        apart = np.where(both >= 0, _apart(x[own], x[both]), np.inf).astype(np.float32)
        order = np.argsort(apart, axis=1, kind="stable")
        links[own] = diverse(x, np.take_along_axis(both, order, 1), np.take_along_axis(apart, order, 1), width)


def descend(x: np.ndarray, graphs: list[np.ndarray], asked: np.ndarray, many: int = 4) -> np.ndarray:
    """Entry nodes of each asked vector for the level below the given graphs (the highest last)."""
    at = np.zeros((len(asked), 1), np.int32)
    for links in reversed(graphs):
        at, _ = beam(x, links, asked, at, many)
    return at


def build_graph(x: np.ndarray, levels: np.ndarray, links: int = LINKS, ef: int = EF_BUILD) -> list[np.ndarray]:
    """Neighbour arrays of the levels from the lowest up; x stands in the order of falling levels."""
    graphs: list[np.ndarray] = []
    for level in range(int(levels.max(initial=0)), -1, -1):
        nodes = int((levels >= level).sum())
        width = links if level else 2 * links
        made = np.full((nodes, width), -1, np.int32)
        at = min(nodes, max(256, len(graphs[0]) if graphs else 0))
        first = True
        begin = 0
        while begin < nodes:
            end = at if first else min(nodes, 2 * begin, begin + BATCH)
            own = x[begin:end]
            inner = ((own**2).sum(axis=1)[:, None] + (own**2).sum(axis=1)[None, :] - 2 * own @ own.T).astype(np.float32)
            np.fill_diagonal(inner, np.inf)
            many = min(ef, end - begin)
            near = np.argpartition(inner, many - 1, axis=1)[:, :many]
            found, gap = near + begin, np.take_along_axis(inner, near, 1)
            if not first:
                known, apart = beam(x, made[:begin], own, descend(x, graphs, own), ef)
                found, gap = np.concatenate([known, found], axis=1), np.concatenate([apart, gap], axis=1)
            order = np.argsort(gap, axis=1, kind="stable")[:, :ef]
            found, gap = np.take_along_axis(found, order, 1), np.take_along_axis(gap, order, 1)
            for k in range(0, end - begin, BATCH):
                made[begin + k : min(end, begin + k + BATCH)] = diverse(x, found[k : k + BATCH], gap[k : k + BATCH], width)
            _link_back(x, made, np.arange(begin, end))
            begin, first = end, False
        graphs.insert(0, made)
    return graphs


INDEX = "_dim int, shard int, nodes int, wide boolean, vectors binary, copies binary, ids binary, graphs array<binary>"


def _index_shard(key: tuple, table: pa.Table, links: int, ef: int) -> pa.Table:
    """One shard as flat arrays: node vectors, first place of each node in ids, ids by node, neighbours by level."""
    dim, shard = (k.as_py() for k in key)
    values = table["embedding"].combine_chunks()
    wide = pa.types.is_float64(values.type.value_type)
    x = values.flatten().to_numpy().reshape(-1, dim)
    x, node = np.unique(x + 0, axis=0, return_inverse=True)
    ids = table["vec_id"].to_numpy()
    order = np.lexsort((ids, node.ravel()))
    ids, node = ids[order], node.ravel()[order]
    start = np.searchsorted(node, np.arange(len(x) + 1))
    first = ids[start[:-1]].astype(np.uint64)
    chance = (mix64(first) >> np.uint64(11)).astype(np.float64) / 2**53
    levels = np.floor(-np.log1p(-chance) / np.log(links)).astype(int)
    rank = np.lexsort((mix64(first + np.uint64(1)), -levels))
    x, levels = x[rank], levels[rank]
    size = np.diff(start)[rank]
    ids = np.concatenate([ids[start[k] : start[k + 1]] for k in rank])
    start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    graphs = build_graph(scaled(x), levels, links, ef)
    row = {
        "_dim": dim, "shard": shard, "nodes": len(x), "wide": wide, "vectors": x.tobytes(), "copies": start.tobytes(),
        "ids": ids.astype(np.int64).tobytes(), "graphs": [g.tobytes() for g in graphs],
    }
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
    return pa.table({k: pa.array([v], kind) for (k, v), kind in zip(row.items(), kinds, strict=True)})


def scaled(x: np.ndarray, by: float = 0.0) -> np.ndarray:
    """Single precision in a range where squares neither overflow nor vanish."""
    return (x / (by or float(np.abs(x).max()))).astype(np.float32)


def build_index(df: DataFrame, shard_rows: int = SHARD, links: int = LINKS, ef: int = EF_BUILD) -> DataFrame:
    """A row per shard with its graph as flat neighbour arrays, kept in the checkpoint folder."""
    rows = usable(df)
    sizes = rows.groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("_shards"))
    dealt = rows.dropDuplicates(["vec_id", "embedding"]).join(sizes, "_dim")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("_shards")).cast("int")).drop("_shards")
    dealt = dealt.repartition(shuffle_partitions(df.sparkSession), "_dim", "shard")

    def index(key: tuple, table: pa.Table) -> pa.Table:
        return _index_shard(key, table, links, ef)

    return checkpoint(dealt.groupBy("_dim", "shard").applyInArrow(index, INDEX))


FOUND = pa.schema([("query_id", pa.int64()), ("_q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search_shard(row: dict, query_ids: np.ndarray, asked: np.ndarray, k: int, ef: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and distances of its k nearest rows found in a shard, by distance and id, without its own vec_id.

    The graph is walked in single precision; all ef nodes found are measured
    again on the original vectors in double precision.  A node's ids are sorted,
    so no more than the first k + 1 of them can be among the k.
    """
    x = np.frombuffer(row["vectors"], np.float64 if row["wide"] else np.float32).reshape(row["nodes"], -1)
    start, ids = np.frombuffer(row["copies"], np.int64), np.frombuffer(row["ids"], np.int64)
    by = float(np.abs(x).max())
    small, low = scaled(x, by), scaled(asked, by)
    graphs = []
    for level, flat in enumerate(row["graphs"]):
        graphs.append(np.frombuffer(flat, np.int32).reshape(-1, row["width"] * (1 if level else 2)))
    found, _ = beam(small, graphs[0], low, descend(small, graphs[1:], low), min(max(ef, k + 1), len(x)))
    told = []
    for own, vector, nodes in zip(query_ids, asked, found, strict=True):
        nodes = nodes[nodes >= 0]
        apart = np.sqrt(((x[nodes].astype(np.float64) - vector) ** 2).sum(axis=1))
        near = np.argsort(apart, kind="stable")
        # nodes at the distance of the last needed one may hold smaller ids
        near = near[apart[near] <= apart[near[min(k, len(near) - 1)]]]
        some = [ids[start[n] : min(start[n + 1], start[n] + k + 1)] for n in nodes[near]]
        far, named = np.repeat(apart[near], [len(s) for s in some]), np.concatenate(some)
        far, named = far[named != own], named[named != own]
        order = np.lexsort((named, far))[:k]
        told.append((named[order], far[order]))
    return told


def search(index: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF, block: int = BLOCK, group: int = GROUP, links: int = LINKS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, nearest first, ties to the smaller vec_id."""
    asked = usable(queries).dropDuplicates(["vec_id", "embedding"]).withColumn("_q", F.xxhash64("embedding"))
    sizes = asked.groupBy("_dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    shards = index.groupBy("_dim").agg((F.max("shard") + 1).alias("_shards"))
    placed = asked.join(sizes, "_dim").withColumn("_block", F.pmod(F.xxhash64("vec_id", "_q"), F.col("_blocks")).cast("int"))
    blocks = placed.groupBy("_dim", "_block").agg(F.collect_list(F.struct("vec_id", "_q", "embedding")).alias("asked"))
    blocks = blocks.join(shards, "_dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("_shards") - 1)))
    blocks = blocks.select("_dim", "shard", F.floor(F.col("_block") / group).cast("int").alias("_group"), "asked")
    groups = sizes.select("_dim", F.explode(F.sequence(F.lit(0), F.floor((F.col("_blocks") - 1) / group).cast("int"))).alias("_group"))
    key = ["_dim", "shard", "_group"]
    parts = shuffle_partitions(index.sparkSession)

    def meet(_: tuple, graph: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        if graph.num_rows and told.num_rows:
            row = graph.to_pylist()[0] | {"width": links}
            for chunk in told["asked"].chunks:
                for k_row in range(len(chunk)):
                    part = chunk.slice(k_row, 1).flatten()
                    own, hashes = part.field("vec_id").to_numpy(), part.field("_q").to_numpy()
                    vectors = part.field("embedding").flatten().to_numpy().astype(np.float64).reshape(len(own), -1)
                    hits = search_shard(row, own, vectors, k, ef)
                    many = [len(h[0]) for h in hits]
                    arrays = [np.repeat(own, many), np.repeat(hashes, many), np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])]
                    out.append(pa.record_batch([pa.array(a, kind) for a, kind in zip(arrays, FOUND.types, strict=True)], schema=FOUND))
        return pa.Table.from_batches(out, FOUND)

    left = index.join(groups, "_dim").repartition(parts, *key).groupBy(*key)
    met = left.cogroup(blocks.repartition(parts, *key).groupBy(*key)).applyInArrow(meet, "query_id long, _q long, vec_id long, score double")
    order = Window.partitionBy("query_id", "_q").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, every: int = 100, k: int = 10, shard_rows: int = SHARD, ef: int = EF) -> DataFrame:
    """The k nearest rows of each row whose vec_id is a multiple of ``every``."""
    return search(build_index(df, shard_rows), df.filter(F.col("vec_id") % every == 0), k, ef)
