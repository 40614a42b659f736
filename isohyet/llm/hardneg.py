"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are ordered along a Hilbert curve through all dimensions (those of
largest deviation first) and written as a Parquet table: a row per block of BLOCK
candidates with the least and the greatest value of every dimension, its labels, and
its ids, labels and vectors as flat arrays.  The columns of the zone maps are read
alone.  Scores are integer inner products, so for an anchor and a block interval
arithmetic gives the greatest and the least score that any row of the block can have:

* a block is read for positives if it holds the anchor's label and its greatest score
  reaches the fifth best positive of the anchor's own block;
* a block is read for a window (an anchor and one of its positives) if it holds
  another label and the interval of its scores meets the window.  In a task, blocks
  of the greatest bounds come first, and those that can't reach the third best
  negative found so far are left.

Segments (the range partitions of the table) in which no block is chosen are not
read at all.  Anchors come in blocks along the same curve.  A task holds one block
of anchors and at most GROUP blocks of candidates or ZONES zone maps.  Where vectors
fill their space evenly, bounds exclude nothing and each block of anchors meets all
blocks; results are exact in any case.

Rows with a null vec_id, label or vector, an empty vector, or null or non-finite
components take no part.  Rows that repeat count once; unlike rows under one vec_id
are rows each, never each other's positives or negatives.  Vectors of different
lengths do not meet.  Other columns are not read.  Scores of 2^53 or more in size
are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.llm.common import checkpoint, shared_folder, shuffle_partitions

#: Candidates and anchors of a block, blocks of candidates and zone maps in a task.
BLOCK, ANCHORS, GROUP, ZONES = 1024, 512, 16, 1024
#: Bits of each dimension in the Hilbert key.
BITS = 3
POSITIVES, NEGATIVES = 5, 3
LARGEST = 1.7976931348623157e308


def usable(df: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, embedding and _dim of the rows that take part, each once."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & (x >= -LARGEST) & (x <= LARGEST)) & (F.size("embedding") > 0)
    rows = df.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    return rows.dropDuplicates(["vec_id", "label", "embedding"]).withColumn("_dim", F.size("embedding"))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x) in double precision."""
    return np.floor(256.0 * x.astype(np.float64))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole rows; exact, as all sums stay under 2^53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= 2.0**53:
        most = np.abs(a) @ np.abs(b).T
        if not (most < 2.0**53).all():
            raise ValueError("scores of 2^53 or more")
    return a @ b.T


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve, as rows of big-endian bytes, of cells with ``bits`` bits a dimension (Skilling's transform)."""
    axes = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for axis in axes:
            set_ = (axis & q) != 0
            swap = np.where(set_, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(set_, low, swap)
            axis ^= swap  # nothing for the first, which is its own partner
        q >>= 1
    for k in range(1, len(axes)):
        axes[k] ^= axes[k - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    q = top
    while q > 1:
        turn ^= np.where(axes[-1] & q, q - 1, 0)
        q >>= 1
    axes ^= turn
    planes = np.concatenate([(axes >> k) & 1 for k in range(bits - 1, -1, -1)])
    return np.packbits(planes.astype(np.uint8).T, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Beginnings and ends of runs of equal neighbours."""
    cut = np.flatnonzero(np.diff(x)) + 1
    ends = [0, *cut.tolist(), len(x)]
    return [(a, b) for a, b in zip(ends, ends[1:], strict=False) if b > a]


def with_key(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """_key: the position on the curve, by cells of each dimension around its mean.

    Means and deviations of the dimensions come to the driver: as many numbers as a
    vector has, whatever the rows.
    """
    told = rows.select("_dim", F.posexplode(rows["embedding"]).alias("at", "x")).groupBy("_dim", "at").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("dev"))
    spread: dict[int, np.ndarray] = {}
    for r in told.collect():
        spread.setdefault(r["_dim"], np.zeros((2, r["_dim"])))[:, r["at"]] = r["mean"], r["dev"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["_dim"].to_numpy()
            for a, b in _runs(dims):
                part = batch.slice(a, b - a)
                mean, dev = spread[int(dims[a])]
                order = np.argsort(-dev, kind="stable")
                place = (_matrix(part["embedding"])[:, order] - mean[order]) / np.where(dev > 0, 4 * dev, 1)[order] + 0.5
                cells = np.clip(np.floor(np.clip(place, 0, 1) * (1 << bits)), 0, (1 << bits) - 1)
                keys = hilbert_keys(cells, bits)
                yield part.append_column("_key", pa.array([k.tobytes() for k in keys], pa.binary()))

    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.mapInArrow(keyed, f"vec_id long, label long, embedding {kind}, _dim int, _key binary")


BLOCKS = pa.schema([
    ("segment", pa.int32()), ("block", pa.int64()), ("_dim", pa.int32()), ("rows", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
    ("kinds", pa.list_(pa.int64())), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("wide", pa.bool_()),
    ("anchors", pa.list_(pa.struct([("vec_id", pa.int64()), ("label", pa.int64()), ("least", pa.float64()), ("vector", pa.binary())]))),
])


def _best(score: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Along the last axis, the ``many`` greatest scores and their ids, greatest first, ties to the smaller id; -inf stands for none."""
    order = np.lexsort((ids, -score), axis=-1)[..., :many]
    return np.take_along_axis(score, order, -1), np.take_along_axis(ids, order, -1)


def _first(score: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """As _best for a matrix whose columns stand in the order of ids; usually only the ``many`` greatest are sorted."""
    many = min(many, score.shape[1])
    if many < score.shape[1] and np.abs(score[np.isfinite(score)]).max(initial=0) < 2.0**40:
        # scores are whole, so a fraction by column breaks ties towards smaller ids
        tied = score - np.arange(score.shape[1]) / (2.0 * score.shape[1])
        some = np.argpartition(-tied, many - 1, axis=1)[:, :many]
        place = np.take_along_axis(some, np.argsort(-np.take_along_axis(tied, some, 1), axis=1), 1)
    else:
        place = np.argsort(-score, axis=1, kind="stable")[:, :many]
    return np.take_along_axis(score, place, 1), ids[place]


def _pack(ids: np.ndarray, labels: np.ndarray, x: np.ndarray, segment: int, number: int, every: int) -> pa.RecordBatch:
    """One block as a row; an anchor comes with the fifth best score of its label in the block (-inf if there are fewer)."""
    order = np.argsort(ids, kind="stable")
    ids, labels, x = ids[order], labels[order], x[order]
    q = whole(x)
    own = np.flatnonzero(ids % every == 0)
    score = np.where((labels[own, None] == labels[None, :]) & (ids[own, None] != ids[None, :]), inner(q[own], q), -np.inf)
    least = np.sort(score, axis=1)[:, -POSITIVES] if score.shape[1] >= POSITIVES else np.full(len(own), -np.inf)
    anchors = [{"vec_id": int(ids[k]), "label": int(labels[k]), "least": float(f), "vector": q[k].tobytes()} for k, f in zip(own, least, strict=True)]
    row = {
        "segment": segment, "block": (segment << 32) + number, "_dim": x.shape[1], "rows": len(ids), "low": q.min(axis=0).tolist(), "high": q.max(axis=0).tolist(),
        "kinds": np.unique(labels).tolist(), "ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": x.tobytes(), "wide": x.dtype == np.float64, "anchors": anchors,
    }
    return pa.RecordBatch.from_pylist([row], BLOCKS)


def write_blocks(rows: DataFrame, path: str, every: int, block: int = BLOCK, bits: int = BITS) -> None:
    """The candidates as a Parquet table of blocks in Hilbert order, in a folder per segment."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def told(size: int) -> pa.RecordBatch:
            nonlocal held, number
            table = pa.Table.from_batches(held)
            part, rest = table.slice(0, size), table.slice(size)
            held = rest.to_batches()
            number += 1
            return _pack(part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["embedding"]), segment, number, every)

        for batch in batches:
            for a, b in _runs(batch["_dim"].to_numpy()):
                part = batch.slice(a, b - a)
                if held and held[0]["_dim"][0].as_py() != part["_dim"][0].as_py():
                    yield told(sum(x.num_rows for x in held))
                held.append(part)
                while sum(x.num_rows for x in held) >= block:
                    yield told(block)
        if held:
            yield told(sum(x.num_rows for x in held))

    order = ["_dim", "_key", "vec_id", "label"]
    dealt = with_key(rows, bits).repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    kind = "segment int, block long, _dim int, rows int, low array<double>, high array<double>, kinds array<long>, ids binary, labels binary, vectors binary, wide boolean, anchors array<struct<vec_id: long, label: long, least: double, vector: binary>>"
    dealt.drop("_key").mapInArrow(packed, kind).write.partitionBy("segment").parquet(path)


ANCHOR_KIND = "_dim int, ablock long, ids binary, labels binary, least binary, vectors binary"


def _anchor_blocks(blocks: DataFrame, size: int) -> DataFrame:
    """Anchors in blocks of ``size`` in the order of the curve: ids, labels, least scores of positives and vectors as flat arrays."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def told() -> pa.RecordBatch:
            row = {
                "_dim": held[0][0], "ablock": (part << 32) + number, "ids": np.array([x[1] for x in held], np.int64).tobytes(), "labels": np.array([x[2] for x in held], np.int64).tobytes(),
                "least": np.array([x[3] for x in held], np.float64).tobytes(), "vectors": b"".join(x[4] for x in held),
            }
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("_dim", "vec_id", "label", "least", "vector")], strict=True):
                if held and (len(held) == size or held[0][0] != row[0]):
                    yield told()
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield told()

    # partitions of some blocks each, so that blocks are full
    many = blocks.agg(F.sum(F.size("anchors"))).first()[0] or 0
    parts = max(1, min(shuffle_partitions(blocks.sparkSession), many // (4 * size)))
    told = blocks.select("_dim", "block", F.explode("anchors").alias("a")).select("_dim", "block", "a.*")
    order = ["_dim", "block", "vec_id", "label"]
    return checkpoint(told.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(packed, ANCHOR_KIND))


class _Anchors:
    """An anchor block's arrays, and the positives found so far (anchors x POSITIVES; -inf and -1 where there are none)."""

    def __init__(self, row: dict) -> None:
        self.ids, self.labels, self.least = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), np.frombuffer(row["least"], np.float64)
        self.x = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        self.score, self.named = np.full((len(self.ids), POSITIVES), -np.inf), np.full((len(self.ids), POSITIVES), -1, np.int64)
        for r in row.get("positives") or []:
            self.score[r["a"], r["rank"] - 1], self.named[r["a"], r["rank"] - 1] = r["score"], r["vec_id"]

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores (anchors x zones) by interval arithmetic."""
        up, down = np.maximum(self.x, 0), np.minimum(self.x, 0)
        return inner(up, low) + inner(down, high), inner(up, high) + inner(down, low)


def _meet(anchors: DataFrame, told: DataFrame, size: int, schema: str, found: object) -> DataFrame:
    """found(anchors, rows) over every anchor block and its rows of ``told`` (_dim, ablock, block, ...), in groups of about ``size`` rows."""
    parts = shuffle_partitions(anchors.sparkSession)
    counts = told.groupBy("_dim", "ablock").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_groups"))
    key = ["_dim", "ablock", "_group"]
    rows = told.join(counts, ["_dim", "ablock"]).withColumn("_group", F.pmod(F.xxhash64("block"), F.col("_groups")).cast("int")).drop("_groups")
    left = anchors.join(counts, ["_dim", "ablock"]).withColumn("_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups")

    def both(_: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        return found(a.to_pylist()[0], b) if a.num_rows and b.num_rows else found(None, b)

    return left.repartition(parts, *key).groupBy(*key).cogroup(rows.repartition(parts, *key).groupBy(*key)).applyInArrow(both, schema)


CHOSEN = pa.schema([("_dim", pa.int32()), ("ablock", pa.int64()), ("segment", pa.int32()), ("block", pa.int64())])


def _choose(anchors: DataFrame, zones: DataFrame, windows: bool) -> DataFrame:
    """The blocks that each anchor block must read, by the bounds of its anchors' scores in them."""

    def found(row: dict | None, told: pa.Table) -> pa.Table:
        if row is None:
            return CHOSEN.empty_table()
        a = _Anchors(row)
        least, most = a.bounds(_matrix(told["low"]), _matrix(told["high"]))
        kinds = told["kinds"].to_pylist()
        if windows:
            other = np.array([[len(k) > 1 or k[0] != label for k in kinds] for label in a.labels])
            p = a.score[:, :, None]
            need = ((100 * most[:, None, :] >= 50 * p) & (100 * least[:, None, :] <= 95 * p) & (p >= 0)).any(axis=1) & other
        else:
            same = np.array([[label in k for k in kinds] for label in a.labels.tolist()])
            need = same & (most >= a.least[:, None])
        hit = need.any(axis=0)
        return pa.table([pa.array([row["_dim"]] * int(hit.sum()), pa.int32()), pa.array([row["ablock"]] * int(hit.sum()), pa.int64()), told["segment"].filter(pa.array(hit)).cast(pa.int32()), told["block"].filter(pa.array(hit))], schema=CHOSEN)

    pairs = zones.join(anchors.groupBy("_dim").agg(F.collect_list("ablock").alias("_all")), "_dim").withColumn("ablock", F.explode("_all")).drop("_all")
    return checkpoint(_meet(anchors, pairs, ZONES, "_dim int, ablock long, segment int, block long", found))


def _payload(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen pairs with the blocks' rows; segments without a chosen block are not read."""
    needed = [r["segment"] for r in chosen.select("segment").distinct().collect()]
    return chosen.drop("segment").join(blocks.filter(F.col("segment").isin(needed)).select("block", "low", "high", "ids", "labels", "vectors", "wide"), "block")


def _candidates(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    return ids, labels, whole(np.frombuffer(row["vectors"], np.float64 if row["wide"] else np.float32).reshape(len(ids), -1))


POSITIVE = pa.schema([("_dim", pa.int32()), ("ablock", pa.int64()), ("a", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _positives(row: dict | None, told: pa.Table) -> pa.Table:
    """The best rows of each anchor's label in some blocks."""
    if row is None:
        return POSITIVE.empty_table()
    a = _Anchors(row)
    score, named = a.score, a.named
    for block in told.to_pylist():
        ids, labels, x = _candidates(block)
        found = np.where((a.labels[:, None] == labels[None, :]) & (a.ids[:, None] != ids[None, :]), inner(a.x, x), -np.inf)
        new, who = _first(found, ids, POSITIVES)
        score, named = _best(np.concatenate([score, new], axis=1), np.concatenate([named, who], axis=1), POSITIVES)
    at, rank = np.nonzero(np.isfinite(score))
    many = len(at)
    return pa.table([pa.array([row["_dim"]] * many, pa.int32()), pa.array([row["ablock"]] * many, pa.int64()), pa.array(at, pa.int32()), pa.array(named[at, rank]), pa.array(score[at, rank])], schema=POSITIVE)


NEGATIVE = pa.schema([(c, pa.int64()) for c in ("anchor_id", "_label", "_a", "ablock", "positive_id", "_rank", "negative_id", "positive_score", "negative_score")])


def _negatives(row: dict | None, told: pa.Table) -> pa.Table:
    """The best rows of other labels in each window in some blocks, those with the greatest bounds first."""
    if row is None:
        return NEGATIVE.empty_table()
    a = _Anchors(row)
    blocks = told.to_pylist()
    least, most = a.bounds(np.array([b["low"] for b in blocks]), np.array([b["high"] for b in blocks]))
    shape = (len(a.ids), POSITIVES, NEGATIVES)
    score, named = np.full(shape, -np.inf), np.full(shape, -1, np.int64)
    floor = np.where(a.score >= 0, 50 * a.score, np.inf)
    for k in np.argsort(-most.max(axis=0), kind="stable"):
        need = (100 * most[:, None, k] >= np.maximum(floor, 100 * score[:, :, -1])) & (100 * least[:, None, k] <= 95 * a.score)
        own = np.flatnonzero(need.any(axis=1))
        if not len(own):
            continue
        ids, labels, x = _candidates(blocks[k])
        found = np.where((a.labels[own, None] == labels[None, :]) | (a.ids[own, None] == ids[None, :]), -np.inf, inner(a.x[own], x))
        order = np.argsort(-found, axis=1, kind="stable")
        found, who = np.take_along_axis(found, order, 1), ids[order]
        for r in range(POSITIVES):
            top = 95 * a.score[own, r]
            begin = (100 * found > top[:, None]).sum(axis=1)
            at = np.minimum(begin[:, None] + np.arange(NEGATIVES), len(ids) - 1)
            new, new_id = np.take_along_axis(found, at, 1), np.take_along_axis(who, at, 1)
            fits = (begin[:, None] + np.arange(NEGATIVES) < len(ids)) & (100 * new >= floor[own, r][:, None]) & np.isfinite(new)
            new = np.where(fits, new, -np.inf)
            score[own, r], named[own, r] = _best(np.concatenate([score[own, r], new], axis=1), np.concatenate([named[own, r], new_id], axis=1), NEGATIVES)
    at, r, rank = np.nonzero(np.isfinite(score))
    columns = [a.ids[at], a.labels[at], at, np.full(len(at), row["ablock"]), a.named[at, r], r, named[at, r, rank], a.score[at, r], score[at, r, rank]]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], schema=NEGATIVE)


def mine(df: DataFrame, label: Column | None = None, every: int = 50, path: str | None = None, block: int = BLOCK, anchors: int = ANCHORS, bits: int = BITS, group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors, whose vec_id is a multiple of ``every``.

    The table of blocks is written to ``path``, by default a new folder in the
    shared one of the session's checkpoints.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/blocks"
    write_blocks(usable(df, F.col("label") if label is None else label), path, every, block, bits)
    kind = "block long, _dim int, rows int, low array<double>, high array<double>, kinds array<long>, ids binary, labels binary, vectors binary, wide boolean, anchors array<struct<vec_id: long, label: long, least: double, vector: binary>>, segment int"
    blocks = spark.read.schema(kind).parquet(path)
    held = _anchor_blocks(blocks, anchors)
    zones = blocks.select("_dim", "segment", "block", "low", "high", "kinds")
    best = _meet(held, _payload(blocks, _choose(held, zones, False)), group, "_dim int, ablock long, a int, vec_id long, score double", _positives)
    order = Window.partitionBy("_dim", "ablock", "a").orderBy(F.desc("score"), "vec_id")
    first = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= POSITIVES)
    told = first.groupBy("_dim", "ablock").agg(F.collect_list(F.struct("a", "rank", "vec_id", "score")).alias("positives"))
    held = checkpoint(held.join(told, ["_dim", "ablock"]))
    found = _meet(held, _payload(blocks, _choose(held, zones, True)), group, ", ".join(f"{c} long" for c in NEGATIVE.names), _negatives)
    order = Window.partitionBy("ablock", "_a", "_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_label() -> Column:
    """The label, moved on by one of ten where vec_id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


ORACLE_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                               list_transform(embedding, lambda x: floor(256e0 * CAST(x AS DOUBLE))) AS q
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3"""
