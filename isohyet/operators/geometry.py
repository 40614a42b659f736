"""Polygon geometry beyond cell weights: overlay, union and repair, as arrangements of edges.

Polygons are rings array<array<struct<x,y>>> (closing points may be left out).  All
edges of some polygons are cut where they meet; on every piece the winding numbers
to the left and to the right tell whether it bounds the result, and the pieces that
do are linked to rings, outer ones counter-clockwise and holes clockwise.  A task
arranges the edges of one pair of polygons, or of one key of a union after shared
edges are cancelled in Spark.  Coordinates are told apart to 1e-9 degrees.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.operators.spatial import authalic_number

SNAP = 9
RINGS = "array<array<struct<x: double, y: double>>>"
Rings = list[np.ndarray]


def points(rings: list[list[dict[str, float]]] | None) -> Rings:
    """Rings as arrays without closing points; rings of fewer than three points, and null ones, go."""
    made = []
    for ring in rings or []:
        p = np.array([(q["x"], q["y"]) for q in ring or [] if q and q["x"] is not None and q["y"] is not None], float).reshape(-1, 2).round(SNAP)
        p = p[np.any(p != np.roll(p, 1, axis=0), axis=1)] if len(p) else p
        if len(p) >= 3:
            made.append(p)
    return made


def signed_area(ring: np.ndarray) -> float:
    """Plain area in square degrees, positive for counter-clockwise rings."""
    x, y = ring[:, 0], ring[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def equal_area(rings: Rings) -> float:
    """Area in the equal-area units of the weight tables: degrees of longitude times the authalic function."""
    total = 0.0
    for r in rings:
        q = authalic_number(r[:, 1])
        total += float((r[:, 0] * (np.roll(q, -1) - np.roll(q, 1))).sum() / 2)
    return total


def oriented(rings: Rings) -> Rings:
    """The first ring counter-clockwise, the others (holes) clockwise."""
    return [r if (signed_area(r) > 0) == (k == 0) else r[::-1] for k, r in enumerate(rings)]


def edges_of(rings: Rings) -> np.ndarray:
    """Edges (x0, y0, x1, y1) of rings."""
    return np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings]) if rings else np.zeros((0, 4))


def _cuts(e: np.ndarray, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """For each place where an edge is met by another edge or its end: the edge's row and the point."""
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    d = e[:, 2:] - e[:, :2]
    rows, found = [], []
    order = np.argsort(low[:, 0], kind="stable")
    starts = low[order, 0]
    for k in range(0, len(e), block):
        own = order[k : k + block]
        # edges that begin before the last of these end
        others = order[: np.searchsorted(starts, high[own, 0].max(), side="right")]
        near = (low[own, None] <= high[None, others] + 1e-12).all(axis=2) & (low[None, others] <= high[own, None] + 1e-12).all(axis=2)
        a, b = np.nonzero(near)
        a, b = own[a], others[b]
        a, b = a[a != b], b[a != b]
        cross = d[a, 0] * d[b, 1] - d[a, 1] * d[b, 0]
        gap = e[b, :2] - e[a, :2]
        flat = np.abs(cross) <= 1e-14 * np.maximum(np.hypot(*d[a].T) * np.hypot(*d[b].T), 1e-300)
        safe = np.where(flat, 1.0, cross)
        t = (gap[:, 0] * d[b, 1] - gap[:, 1] * d[b, 0]) / safe
        u = (gap[:, 0] * d[a, 1] - gap[:, 1] * d[a, 0]) / safe
        hit = ~flat & (t > -1e-12) & (t < 1 + 1e-12) & (u > -1e-12) & (u < 1 + 1e-12)
        rows.append(a[hit])
        found.append(e[a[hit], :2] + t[hit, None] * d[a[hit]])
        # on one line: the other's ends that lie on this edge
        size = (d[a] ** 2).sum(axis=1)
        for end in (e[:, :2], e[:, 2:]):
            off = end[b] - e[a, :2]
            t = (off * d[a]).sum(axis=1) / size
            apart = np.abs(off[:, 0] * d[a, 1] - off[:, 1] * d[a, 0]) / np.sqrt(size)
            on = flat & (t > 0) & (t < 1) & (apart <= 10.0**-SNAP)
            rows.append(a[on])
            found.append(end[b[on]])
    return np.concatenate(rows) if rows else np.zeros(0, int), np.concatenate(found).round(SNAP) if found else np.zeros((0, 2))


def cut(e: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of edges between the places where edges meet, with their labels."""
    row, at = _cuts(e)
    ends = np.arange(len(e))
    row, at = np.concatenate([ends, row, ends]), np.concatenate([e[:, :2], at, e[:, 2:]])
    d = (e[:, 2:] - e[:, :2])[row]
    t = ((at - e[row, :2]) * d).sum(axis=1)
    order = np.lexsort((t, row))
    row, at = row[order], at[order]
    same = row[1:] == row[:-1]
    pieces = np.hstack([at[:-1], at[1:]])[same]
    label = label[row[:-1][same]]
    real = (pieces[:, :2] != pieces[:, 2:]).any(axis=1)
    return pieces[real], label[real]


def winding(at: np.ndarray, e: np.ndarray, block: int = 1024) -> np.ndarray:
    """Winding numbers of edges around points that lie on none of them."""
    out = np.zeros(len(at), int)
    for k in range(0, len(at), block):
        x, y = at[k : k + block, 0:1], at[k : k + block, 1:2]
        up, down = (e[:, 1] <= y) & (e[:, 3] > y), (e[:, 3] <= y) & (e[:, 1] > y)
        side = (e[:, 2] - e[:, 0]) * (y - e[:, 1]) - (x - e[:, 0]) * (e[:, 3] - e[:, 1])
        out[k : k + block] = (up & (side > 0)).sum(axis=1) - (down & (side < 0)).sum(axis=1)
    return out


def arrange(e: np.ndarray, label: np.ndarray, labels: int, inside: Callable[[np.ndarray], np.ndarray]) -> Rings:
    """Rings around the points for whose winding numbers (a column per label) ``inside`` holds."""
    if not len(e):
        return []
    pieces, label = cut(e, label)
    forward = (pieces[:, 0] < pieces[:, 2]) | ((pieces[:, 0] == pieces[:, 2]) & (pieces[:, 1] < pieces[:, 3]))
    pieces = np.where(forward[:, None], pieces, pieces[:, [2, 3, 0, 1]])
    told, at = np.unique(pieces, axis=0, return_inverse=True)
    net = np.zeros((len(told), labels), int)
    np.add.at(net, (at.ravel(), label), np.where(forward, 1, -1))
    told, net = told[(net != 0).any(axis=1)], net[(net != 0).any(axis=1)]
    # a ray from the middle of a piece to the right: what it crosses, and what lies along or on it
    d = told[:, 2:] - told[:, :2]
    size = np.hypot(*d.T)
    middle, normal = (told[:, :2] + told[:, 2:]) / 2, np.stack([-d[:, 1], d[:, 0]], axis=1) / np.maximum(size, 1e-300)[:, None]
    away = middle + normal * np.minimum(1e-7, size / 4)[:, None]
    held = [np.repeat(told, np.abs(net[:, k]), axis=0) if (net[:, k] != 0).any() else told[:0] for k in range(labels)]
    signs = [np.repeat(np.sign(net[:, k]), np.abs(net[:, k])) for k in range(labels)]
    left = np.stack([winding(away, np.where(s[:, None] > 0, h, h[:, [2, 3, 0, 1]])) for h, s in zip(held, signs, strict=True)], axis=1)
    keep_left, keep_right = inside(left), inside(left - net)
    kept = np.concatenate([told[keep_left & ~keep_right], told[keep_right & ~keep_left][:, [2, 3, 0, 1]]])
    return link(kept)


def link(e: np.ndarray) -> Rings:
    """Rings of directed edges; where several go on from a point, the sharpest turn to the right keeps rings apart that only touch."""
    out: dict[tuple[float, float], list[int]] = defaultdict(list)
    for k, p in enumerate(map(tuple, e[:, :2].tolist())):
        out[p].append(k)
    used, rings = np.zeros(len(e), bool), []
    angle = np.arctan2(e[:, 3] - e[:, 1], e[:, 2] - e[:, 0])
    for first in range(len(e)):
        if used[first]:
            continue
        ring, k = [], first
        while not used[k]:
            used[k] = True
            ring.append(e[k, :2])
            following = [n for n in out[tuple(e[k, 2:].tolist())] if not used[n]]
            if not following:
                break
            k = min(following, key=lambda n: (angle[k] + np.pi - angle[n] - 1e-12) % (2 * np.pi) if len(following) > 1 else 0.0)
        r = np.array(ring)
        # points in the middle of a straight line say nothing
        a, b = r - np.roll(r, 1, axis=0), np.roll(r, -1, axis=0) - r
        bend = np.abs(a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]) > 1e-15
        r = r[bend]
        if len(r) >= 3:
            rings.append(r)
    return sorted(rings, key=lambda r: -abs(signed_area(r)))


def intersection(a: Rings, b: Rings) -> Rings:
    ea, eb = edges_of(oriented(a)), edges_of(oriented(b))
    if not len(ea) or not len(eb):
        return []
    return arrange(np.concatenate([ea, eb]), np.repeat([0, 1], [len(ea), len(eb)]), 2, lambda w: (w[:, 0] > 0) & (w[:, 1] > 0))


def repaired(rings: Rings) -> Rings:
    """Rings without self-crossings: what an odd number of windings covers."""
    e = edges_of(rings)
    return arrange(e, np.zeros(len(e), int), 1, lambda w: w[:, 0] % 2 == 1)


# In Spark ---------------------------------------------------------------------------------------------


def _told(rings: Rings) -> list[list[dict[str, float]]]:
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


RINGS_TYPE = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def boxed(polygons: DataFrame) -> DataFrame:
    """west, south, east and north of polygons; those without points have none."""
    ends = F.flatten("rings")
    side = lambda f, c: f(F.transform(ends, lambda p: p[c]))
    return polygons.withColumns({"west": side(F.array_min, "x"), "east": side(F.array_max, "x"), "south": side(F.array_min, "y"), "north": side(F.array_max, "y")})


def overlay(left: DataFrame, right: DataFrame, left_key: str, right_key: str, step: float = 1.0) -> DataFrame:
    """left_key, right_key, rings, area of all pairs of polygons that overlap by more than a sliver.

    Boxes are posted to squares of ``step`` degrees and meet by an equi-join; a pair
    is kept in the one square that holds the south-west corner of its common box,
    so no pair is told twice.  Keys and boxes make the pairs; rings join them after.
    Choose ``step`` near the size of the smaller polygons.  Rows whose polygon is
    null or empty have no pairs; keys are taken to be unique.
    """

    def posted(df: DataFrame, key: str, to: str) -> DataFrame:
        at = lambda c: F.floor(F.col(c) / step)
        made = boxed(df).filter(F.col("west").isNotNull()).select(F.col(key).alias(to), *[F.col(c).alias(f"{to}{c}") for c in ("west", "south", "east", "north")], F.explode(F.sequence(at("west"), at("east"))).alias("_i"), "south", "north")
        return made.withColumn("_j", F.explode(F.sequence(at("south"), at("north")))).drop("south", "north")

    met = posted(left, left_key, "_a").join(posted(right, right_key, "_b"), ["_i", "_j"])
    west, south = F.greatest("_awest", "_bwest"), F.greatest("_asouth", "_bsouth")
    apart = (west >= F.least("_aeast", "_beast")) | (south >= F.least("_anorth", "_bnorth"))
    pairs = met.filter(~apart & (F.floor(west / step) == F.col("_i")) & (F.floor(south / step) == F.col("_j"))).select("_a", "_b")
    told = pairs.join(left.select(F.col(left_key).alias("_a"), F.col("rings").alias("_ra")), "_a").join(right.select(F.col(right_key).alias("_b"), F.col("rings").alias("_rb")), "_b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, rings, areas = [], [], []
            for k, (a, b) in enumerate(zip(batch["_ra"], batch["_rb"], strict=True)):
                made = intersection(points(a.as_py()), points(b.as_py()))
                area = equal_area(made)
                if area > 1e-12:
                    rows.append(k)
                    rings.append(_told(made))
                    areas.append(area)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["_a"].take(at), batch["_b"].take(at), pa.array(rings, RINGS_TYPE), pa.array(areas, pa.float64())], names=[left_key, right_key, "rings", "area"])

    kinds = dict(left.dtypes)[left_key], dict(right.dtypes)[right_key]
    return told.select("_a", "_b", "_ra", "_rb").mapInArrow(work, f"`{left_key}` {kinds[0]}, `{right_key}` {kinds[1]}, rings {RINGS}, area double")


def repair(polygons: DataFrame, key: str) -> DataFrame:
    """key, rings, area: polygons without self-crossings, oriented; a polygon that vanishes has no rings and area 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [repaired(points(r.as_py())) for r in batch["rings"]]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array([_told(m) for m in made], RINGS_TYPE), pa.array([equal_area(m) for m in made])], names=[key, "rings", "area"])

    return polygons.select(key, "rings").mapInArrow(work, f"`{key}` {dict(polygons.dtypes)[key]}, rings {RINGS}, area double")


def dissolve_rings(polygons: DataFrame, key: str, unit: str) -> DataFrame:
    """key, rings, area, parts: the union of each key's polygons (rows with a unit of their own), whether they touch or overlap.

    Polygons are repaired first.  Edges that two neighbours share cancel in a
    grouped sum, so of a tiling only the outline goes on; one task arranges what is
    left of a key.  Rows without a key are left out, as in a grouping by name.
    """
    clean = repair(polygons.filter(F.col(key).isNotNull()).withColumn("_id", F.struct(key, unit)), "_id")
    ring = F.explode("rings")
    steps = clean.select(F.col(f"_id.{key}").alias(key), ring.alias("r"))
    following: Column = F.concat(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1))
    edge = steps.select(key, F.explode(F.arrays_zip(F.col("r").alias("a"), following.alias("b"))).alias("e")).select(key, "e.a", "e.b")
    ahead = (F.col("a.x") < F.col("b.x")) | ((F.col("a.x") == F.col("b.x")) & (F.col("a.y") < F.col("b.y")))
    told = edge.select(key, F.when(ahead, F.col("a")).otherwise(F.col("b")).alias("p"), F.when(ahead, F.col("b")).otherwise(F.col("a")).alias("q"), F.when(ahead, 1).otherwise(-1).alias("n"))
    net = told.groupBy(key, "p", "q").agg(F.sum("n").alias("n")).filter("n <> 0")
    flat = net.select(key, F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("q.x").alias("x1"), F.col("q.y").alias("y1"), "n")

    def work(name: tuple, table: pa.Table) -> pa.Table:
        e = np.stack([table[c].to_numpy() for c in ("x0", "y0", "x1", "y1")], axis=1)
        n = table["n"].to_numpy()
        e = np.repeat(np.where((n > 0)[:, None], e, e[:, [2, 3, 0, 1]]), np.abs(n), axis=0)
        made = arrange(e, np.zeros(len(e), int), 1, lambda w: w[:, 0] > 0)
        parts = sum(signed_area(r) > 0 for r in made)
        return pa.table([pa.array([name[0].as_py()], name[0].type), pa.array([_told(made)], RINGS_TYPE), pa.array([equal_area(made)]), pa.array([parts], pa.int32())], names=[key, "rings", "area", "parts"])

    return flat.groupBy(key).applyInArrow(work, f"`{key}` {dict(polygons.dtypes)[key]}, rings {RINGS}, area double, parts int")
