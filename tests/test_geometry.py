"""Cell weights of general polygons, curvilinear grids, overlay, union and repair."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet.operators import geometry as geo
from isohyet.operators import spatial as sp

GRID = sp.Grid(44.0, -96.0, 0.1, 0.1, 20, 30)
KIND = "id int, rings array<array<struct<x: double, y: double>>>"


def polygons(spark, *rings):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in p]) for k, p in enumerate(rings)], KIND)


def clipped(ring, west, south, east, north):
    """Plain clipping of a ring to a rectangle, edge after edge."""
    for axis, bound, sign in ((0, west, 1), (0, east, -1), (1, south, 1), (1, north, -1)):
        out = []
        for a, b in zip([ring[-1], *ring[:-1]] if ring else [], ring):
            ia, ib = sign * (a[axis] - bound) >= 0, sign * (b[axis] - bound) >= 0
            if ia != ib:
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
            if ib:
                out.append(b)
        ring = out
    return ring


def area(ring):
    return abs(geo.equal_area([np.array(ring)])) if len(ring) > 2 else 0.0


def star(rng, x, y, size, many):
    angles = np.sort(rng.uniform(0, 2 * np.pi, many))
    r = size * rng.uniform(0.3, 1, many)
    return [(x + a * math.cos(t), y + a * math.sin(t)) for a, t in zip(r, angles)]


def test_overlaps_equal_clipping(spark):
    rng = np.random.default_rng(3)
    shapes = [[star(rng, -95.0 + k * 0.3, 44.6 + 0.1 * k, 0.5, 40)] for k in range(5)]
    shapes.append([[(-94.5, 44.2), (-93.5, 44.2), (-93.5, 45.2), (-94.5, 45.2)], star(rng, -94.0, 44.7, 0.4, 12)])
    shapes.append([[(-97, 43), (-92, 43), (-92, 47), (-97, 47)]])
    shapes.append([[(-96.4, 44.05), (-95.95, 44.05), (-95.95, 44.15), (-96.4, 44.15)]])
    shapes.append([[(-93.05, 45.95), (-92, 45.95), (-92, 47), (-93.05, 47)][::-1]])
    shapes.append([[(0, 0), (1, 0), (1, 1)]])
    got = {(r["id"], r["lat_idx"], r["lon_idx"]): r["overlap"] for r in sp.polygon_overlaps(polygons(spark, *shapes), GRID, "id").collect()}
    want = {}
    for k, rings in enumerate(shapes):
        for i in range(20):
            for j in range(30):
                w, s = GRID.west + j * 0.1, GRID.south + i * 0.1
                e, n = GRID.west + (j + 1) * 0.1, GRID.south + (i + 1) * 0.1
                parts = [area(clipped(list(r), w, s, e, n)) for r in rings]
                if parts[0] - sum(parts[1:]) > 1e-12:
                    want[k, i, j] = (parts[0] - sum(parts[1:])) / area([(w, s), (e, s), (e, n), (w, n)])
    assert {k for k, v in got.items() if v > 1e-9} == {k for k, v in want.items() if v > 1e-9}
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_many_cells_and_vertices_take_seconds():
    """A ring of 10,000 points over 100,000 cells."""
    t = np.linspace(0, 2 * np.pi, 10_001)[:-1]
    ring = np.stack([-90 + 5 * np.cos(t) * (1 + 0.05 * np.sin(97 * t)), 45 + 5 * np.sin(t) * (1 + 0.05 * np.sin(97 * t))], axis=1)
    grid = sp.Grid(39.0, -96.0, 0.035, 0.035, 345, 345)
    began = time.time()
    held, _, cell = sp.cell_areas([ring], grid, 0, 344)
    assert time.time() - began < 5
    # a fine grid cuts each edge at more places than the plain area does, where lines in degrees bend in equal-area units
    assert abs(held.sum() / abs(geo.equal_area([ring])) - 1) < 1e-6 and (held / cell[:, None]).max() < 1 + 1e-9 and ((held / cell[:, None]) > 1 - 1e-9).sum() > 50_000


def rotated(spark, many=12, turn=0.4, size=0.2, bend=0.0):
    rows = []
    for y in range(many):
        for x in range(many):
            u, v = x * size + bend * y * y, y * size
            rows.append((y, x, 44 + u * math.sin(turn) + v * math.cos(turn), -96 + u * math.cos(turn) - v * math.sin(turn), 1.0))
    return spark.createDataFrame(rows, "y int, x int, lat double, lon double, one double")


@pytest.mark.parametrize("bend", [0.0, 0.004])
def test_curvilinear_weights_give_back_the_position(spark, bend):
    """Weights sum to one, and the weighted centres are the target; on a rotated grid they are those of the regular case."""
    centres = rotated(spark, bend=bend)
    rng = np.random.default_rng(1)
    told = [(k, float(a), float(b)) for k, (a, b) in enumerate(zip(rng.uniform(44.3, 45.6, 200), rng.uniform(-96.2, -94.9, 200)))]
    weights = sp.curvilinear_weights(spark.createDataFrame(told, "target_id int, lat double, lon double"), centres)
    back = weights.join(centres, ["y", "x"]).groupBy("target_id").agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("lat")).alias("lat"), F.sum(F.col("weight") * F.col("lon")).alias("lon"), F.min("weight").alias("least")).collect()
    assert len(back) > 150
    for r in back:
        assert abs(r["w"] - 1) < 1e-9 and r["least"] > 0
        assert abs(r["lat"] - told[r["target_id"]][1]) < 1e-9 and abs(r["lon"] - told[r["target_id"]][2]) < 1e-9
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_curvilinear_equals_regular(spark):
    grid = sp.Grid(44.0, -96.0, 0.5, 0.5, 4, 5)
    centres = spark.createDataFrame([(i, j, 44.25 + 0.5 * i, -95.75 + 0.5 * j) for i in range(4) for j in range(5)], "y int, x int, lat double, lon double")
    targets = sp.regular_targets(spark, sp.BoundingBox(-95.75, 44.25, -93.75, 45.75), 0.1)
    a = {(r["target_id"], r["lat_idx"], r["lon_idx"]): round(r["weight"], 9) for r in sp.bilinear_weights(targets, grid).collect() if r["weight"] > 1e-9}
    b = {(r["target_id"], r["y"], r["x"]): round(r["weight"], 9) for r in sp.curvilinear_weights(targets, centres).collect() if r["weight"] > 1e-9}
    assert a == b and targets.count() == 15 * 20
    cells = centres.selectExpr("y", "x", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS time", "CASE WHEN y = 0 AND x = 0 THEN NULL ELSE 2 * lat - lon END AS v")
    out = {r["target_id"]: r["v"] for r in sp.regrid_curvilinear(cells, targets, centres, ["v"]).collect()}
    for t in targets.collect():
        near_gap = t["lat"] < 44.75 - 1e-9 and t["lon"] < -95.25 - 1e-9
        assert (out[t["target_id"]] is None) if near_gap else abs(out[t["target_id"]] - (2 * t["lat"] - t["lon"])) < 1e-9


def box(w, s, e, n):
    return [[(w, s), (e, s), (e, n), (w, n)]]


def flat(rings):
    return sum(geo.signed_area(r) for r in rings)


def test_intersection_of_shapes():
    a, b = geo.points([[{"x": x, "y": y} for x, y in box(0, 0, 4, 4)[0]]]), geo.points([[{"x": x, "y": y} for x, y in box(2, 1, 6, 3)[0]]])
    assert flat(geo.intersection(a, b)) == pytest.approx(4)
    hole = [np.array(box(0, 0, 4, 4)[0], float), np.array(box(1, 1, 3, 3)[0], float)]
    assert flat(geo.intersection(hole, b)) == pytest.approx(4 - 2)
    assert geo.intersection(a, [np.array(box(4, 0, 5, 4)[0], float)]) == []
    assert flat(geo.intersection(a, a)) == pytest.approx(16)
    inner = [np.array(box(1, 1, 2, 2)[0], float)]
    assert flat(geo.intersection(a, inner)) == pytest.approx(1) == flat(geo.intersection(inner, a))


def test_intersection_and_union_by_inclusion_exclusion():
    rng = np.random.default_rng(11)
    for _ in range(30):
        a, b = ([np.array(star(rng, *rng.uniform(-0.5, 0.5, 2), 1.0, 25)).round(geo.SNAP)] for _ in range(2))
        e = np.concatenate([geo.edges_of(geo.oriented(a)), geo.edges_of(geo.oriented(b))])
        union = geo.arrange(e, np.zeros(len(e), int), 1, lambda w: w[:, 0] > 0)
        assert flat(union) + flat(geo.intersection(a, b)) == pytest.approx(abs(flat(a)) + abs(flat(b)), abs=1e-7)
        # by points
        at = rng.uniform(-1.5, 1.5, (400, 2))
        in_a, in_b = (np.abs(geo.winding(at, geo.edges_of(x))) % 2 == 1 for x in (a, b))
        assert ((geo.winding(at, geo.edges_of(union)) > 0) == (in_a | in_b)).all()


def test_repair(spark):
    bow = [[(0, 0), (2, 2), (2, 0), (0, 2)]]
    made = {r["id"]: r for r in geo.repair(polygons(spark, bow, [[(0, 0), (1, 1)]], box(0, 0, 1, 1)), "id").collect()}
    assert sum(geo.signed_area(p) for p in geo.points(made[0]["rings"])) == pytest.approx(2) and len(made[0]["rings"]) == 2
    assert made[1]["rings"] == [] and made[1]["area"] == 0 and len(made[2]["rings"][0]) == 4


def test_overlay(spark):
    rng = np.random.default_rng(5)
    left, right = [[star(rng, *rng.uniform(0, 5, 2), 1.2, 9)] for _ in range(25)], [box(x, y, x + 1.5, y + 1.0) for x, y in rng.uniform(0, 5, (25, 2))]
    a, b = polygons(spark, *left), polygons(spark, *right).withColumnRenamed("id", "other")
    made = geo.overlay(a, b, "id", "other", 0.7)
    got = {(r["id"], r["other"]): r["area"] for r in made.collect()}
    want = {}
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            part = area(clipped(list(x[0]), *y[0][0], *y[0][2]))
            if part > 1e-9:
                want[i, j] = part
    assert got.keys() == want.keys() and made.count() == len(got)
    assert all(abs(got[k] - v) < 1e-6 for k, v in want.items())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert geo.overlay(a.limit(0), b, "id", "other").count() == 0
    assert geo.overlay(spark.createDataFrame([(1, None), (2, [])], KIND), b, "id", "other").count() == 0


def test_dissolve(spark):
    """Two catchment squares that share an edge, one apart, and overlapping squares around a hole."""
    squares = [("A", 0, box(0, 0, 1, 1)), ("A", 1, box(1, 0, 2, 1)), ("B", 2, box(5, 5, 6, 6)), ("B", 3, box(8, 8, 9, 9)), (None, 4, box(0, 0, 9, 9))]
    squares += [("C", 5 + k, p) for k, p in enumerate((box(0, 0, 3, 1), box(0, 0, 1, 3), box(2, 0, 3, 3), box(0, 2, 3, 3)))]
    df = spark.createDataFrame([(z, k, [[(float(x), float(y)) for x, y in r] for r in p]) for z, k, p in squares], "zone string, unit int, rings array<array<struct<x: double, y: double>>>")
    made = {r["zone"]: r for r in geo.dissolve_rings(df, "zone", "unit").collect()}
    assert set(made) == {"A", "B", "C"}
    shape = lambda z: ([len(r) for r in made[z]["rings"]], made[z]["parts"], round(sum(geo.signed_area(p) for p in geo.points(made[z]["rings"])), 9))
    assert shape("A") == ([4], 1, 2.0) and shape("B") == ([4, 4], 2, 2.0) and shape("C") == ([4, 4], 1, 8.0)


def test_tiling_leaves_its_outline(spark):
    tiles = [("z", 30 * i + j, box(j * 0.1, i * 0.1, (j + 1) * 0.1, (i + 1) * 0.1)) for i in range(30) for j in range(30)]
    df = spark.createDataFrame([(z, k, [[(float(x), float(y)) for x, y in r] for r in p]) for z, k, p in tiles], "zone string, unit int, rings array<array<struct<x: double, y: double>>>")
    made = geo.dissolve_rings(df, "zone", "unit").first()
    assert len(made["rings"]) == 1 and len(made["rings"][0]) == 4 and made["parts"] == 1
