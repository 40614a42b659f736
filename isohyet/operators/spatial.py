"""Grids, bounding boxes, polygon weights and zonal sums.

Areas are those of the ellipsoidal cylindrical equal-area projection (WGS84):
proportional to the longitude difference times the difference of the authalic
function q of latitude.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isohyet.functions.cols import clip, ratio
from isohyet.functions.radiation import monthly_at

E2 = 0.0066943799901413165
E1 = math.sqrt(E2)
#: Overlaps narrower than this, in degrees, are rounding.
SLIVER = 1e-9
#: Weight tables up to so many rows are broadcast.
BROADCAST_WEIGHTS = 500_000


@dataclass(frozen=True)
class BoundingBox:
    west: float
    south: float
    east: float
    north: float

    def contains(self, other: BoundingBox) -> bool:
        return self.west <= other.west and self.south <= other.south and self.east >= other.east and self.north >= other.north

    def ring(self) -> list[tuple[float, float]]:
        return [(self.west, self.south), (self.east, self.south), (self.east, self.north), (self.west, self.north), (self.west, self.south)]

    def holds(self, lat: Column, lon: Column, pad_lat: float = 0.0, pad_lon: float = 0.0) -> Column:
        return lat.between(self.south - pad_lat, self.north + pad_lat) & lon.between(self.west - pad_lon, self.east + pad_lon)


DEFAULT_REGION = BoundingBox(-97.5, 43.0, -89.0, 50.0)


def clip_grid(df: DataFrame, box: BoundingBox, dlat: float, dlon: float) -> DataFrame:
    """Cells that touch the box: centres within it or half a cell beyond."""
    return df.filter(box.holds(F.col("lat"), F.col("lon"), dlat / 2, dlon / 2))


def wrap_longitude(lon: Column) -> Column:
    """0..360 to -180..180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def generate_grid(spark: SparkSession, box: BoundingBox, step: float) -> DataFrame:
    """row_id, column_id, centre and edges of the cells that tile a box."""
    rows, columns = round((box.north - box.south) / step), round((box.east - box.west) / step)
    ids = spark.range(rows * columns).select((F.col("id") / columns).cast("int").alias("row_id"), (F.col("id") % columns).cast("int").alias("column_id"))
    return ids.select(
        "row_id", "column_id", F.round(box.south + (F.col("row_id") + 0.5) * step, 6).alias("lat"), F.round(box.west + (F.col("column_id") + 0.5) * step, 6).alias("lon"),
        (box.west + F.col("column_id") * step).alias("west"), (box.south + F.col("row_id") * step).alias("south"), (box.west + (F.col("column_id") + 1) * step).alias("east"), (box.south + (F.col("row_id") + 1) * step).alias("north"),
    )


def authalic(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))


@dataclass(frozen=True)
class Grid:
    """A regular grid: south and west edges, spacing and size."""

    south: float
    west: float
    dlat: float
    dlon: float
    rows: int
    columns: int


def _candidates(low: Column, high: Column, start: float, step: float, size: int) -> Column:
    first = F.greatest(F.floor((low - start) / step).cast("int"), F.lit(0))
    last = F.least(F.floor((high - start) / step).cast("int"), F.lit(size - 1))
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def rectangle_overlaps(rectangles: DataFrame, grid: Grid) -> DataFrame:
    """Candidate cells by index arithmetic, with overlap (share of the cell) and areas in equal-area units."""
    cells = rectangles.withColumn("lat_idx", F.explode(_candidates(F.col("south"), F.col("north"), grid.south, grid.dlat, grid.rows))).withColumn(
        "lon_idx", F.explode(_candidates(F.col("west"), F.col("east"), grid.west, grid.dlon, grid.columns))
    )
    s, w = grid.south + F.col("lat_idx") * grid.dlat, grid.west + F.col("lon_idx") * grid.dlon
    n, e = grid.south + (F.col("lat_idx") + 1) * grid.dlat, grid.west + (F.col("lon_idx") + 1) * grid.dlon
    top, bottom = F.least(n, F.col("north")), F.greatest(s, F.col("south"))
    right, left = F.least(e, F.col("east")), F.greatest(w, F.col("west"))
    cell = (e - w) * (authalic(n) - authalic(s))
    part = (right - left) * (authalic(top) - authalic(bottom))
    made = cells.withColumns({"overlap_area": part, "cell_area": cell}).filter((top - bottom > SLIVER) & (right - left > SLIVER))
    return made.withColumn("overlap", F.col("overlap_area") / F.col("cell_area"))


def rectangle_coverage(overlaps: DataFrame, key: str) -> DataFrame:
    """Share of each rectangle that lies on the grid."""
    whole = (F.col("east") - F.col("west")) * (authalic(F.col("north")) - authalic(F.col("south")))
    return overlaps.groupBy(key).agg(F.coalesce(ratio(F.sum("overlap_area"), F.first(whole)), F.lit(0.0)).alias("coverage"))


def build_weights(overlaps: DataFrame, key: str, min_coverage: float = 0.99, on_low_coverage: str = "zero", normalize: bool = True, valid: DataFrame | None = None) -> DataFrame:
    """key, lat_idx, lon_idx, weight, coverage; weights of a polygon sum to 1.

    Polygons covered less than min_coverage lose their weights ("zero"), keep
    them ("keep") or stop the query ("error"); with "error" a polygon without any
    cell cannot be told from one that is not there, so ask ``uncovered`` for those.
    ``valid`` (lat_idx, lon_idx) names the cells that hold data: the others' weights
    go after the weights were made to sum to 1.
    """
    if on_low_coverage not in ("zero", "keep", "error"):
        raise ValueError("on_low_coverage must be zero, keep or error")
    whole = (F.col("east") - F.col("west")) * (authalic(F.col("north")) - authalic(F.col("south")))
    of = Window.partitionBy(key)
    joined = overlaps.withColumns({"coverage": F.coalesce(ratio(F.sum("overlap_area").over(of), F.first(whole).over(of)), F.lit(0.0)), "_total": F.sum("overlap").over(of)})
    low = F.col("coverage") < min_coverage
    if on_low_coverage == "zero":
        joined = joined.filter(~low)
    elif on_low_coverage == "error":
        joined = joined.withColumn("coverage", F.when(low, F.raise_error(F.concat(F.lit("low coverage of "), F.col(key).cast("string")))).otherwise(F.col("coverage")))
    weight = ratio("overlap", "_total") if normalize else F.col("overlap")
    made = joined.select(key, "lat_idx", "lon_idx", weight.alias("weight"), "coverage")
    return made.join(valid.select("lat_idx", "lon_idx").distinct(), ["lat_idx", "lon_idx"], "left_semi").select(*made.columns) if valid is not None else made


def uncovered(rectangles: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """Polygons without any weight."""
    return rectangles.join(weights.select(key).distinct(), key, "left_anti")


def polygon_weights(rectangles: DataFrame, grid: Grid, key: str, name: object, min_coverage: float = 0.99) -> DataFrame:
    """The weights of one polygon."""
    return build_weights(rectangle_overlaps(rectangles.filter(F.col(key) == F.lit(name)), grid), key, min_coverage)


def contained(box: BoundingBox) -> Column:
    """Whether a row's rectangle (west, south, east, north) lies in the box, edges included."""
    return (F.col("west") >= box.west) & (F.col("south") >= box.south) & (F.col("east") <= box.east) & (F.col("north") <= box.north)


def region_fractions(overlaps: DataFrame, key: str) -> DataFrame:
    """Shares of each region's own area by cell, which sum to 1 (not shares of cells)."""
    return overlaps.withColumn("fraction", ratio("overlap_area", F.sum("overlap_area").over(Window.partitionBy(key)))).select(key, "lat_idx", "lon_idx", "fraction")


def dissolve(overlaps: DataFrame, key: str) -> DataFrame:
    """Overlaps by a coarser key: areas add up, at most to a whole cell; ``capped`` marks double cover."""
    added = overlaps.groupBy(key, "lat_idx", "lon_idx").agg(F.sum("overlap").alias("_sum"))
    return added.select(key, "lat_idx", "lon_idx", F.least("_sum", F.lit(1.0)).alias("overlap"), (F.col("_sum") > 1 + 1e-9).alias("capped"))


def with_weights(cells: DataFrame, weights: DataFrame, n_weights: int | None = None) -> DataFrame:
    """Cells beside the weights of every polygon that they touch; weights are broadcast up to a checked number of rows."""
    n = weights.count() if n_weights is None else n_weights
    return cells.join(F.broadcast(weights) if n <= BROADCAST_WEIGHTS else weights, ["lat_idx", "lon_idx"])


def zonal_sum(cells: DataFrame, weights: DataFrame, key: str, values: list[str], time: str = "time", renormalize: bool = False, n_weights: int | None = None) -> DataFrame:
    """Weighted sums by key and time; cells without a value add 0, or, with renormalize, leave the mean."""
    joined = with_weights(cells, weights, n_weights)
    made = []
    for v in values:
        total = F.sum(F.col(v) * F.col("weight"))
        made.append((ratio(total, F.sum(F.when(F.col(v).isNotNull(), F.col("weight")))) if renormalize else F.coalesce(total, F.lit(0.0))).alias(v))
    return joined.groupBy(key, time).agg(*made)


def authalic_number(lat: np.ndarray) -> np.ndarray:
    """``authalic`` of numbers."""
    s = np.sin(np.radians(lat))
    return (1 - E2) * (s / (1 - E2 * s * s) - np.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))


def _pieces(ring: np.ndarray, grid: Grid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A ring's edges cut at all grid lines: rows, columns and (x0, q0, x1, q1) of the pieces; each lies in one cell."""
    a, b = ring, np.roll(ring, -1, axis=0)
    start, step = np.array([grid.west, grid.south]), np.array([grid.dlon, grid.dlat])
    ga, gb = (a - start) / step, (b - start) / step
    edge, t = [np.arange(len(a)), np.arange(len(a))], [np.zeros(len(a)), np.ones(len(a))]
    for axis in (0, 1):
        low, high = np.minimum(ga[:, axis], gb[:, axis]), np.maximum(ga[:, axis], gb[:, axis])
        first, many = np.floor(low) + 1, np.maximum(np.ceil(high) - np.floor(low) - 1, 0).astype(int)
        row = np.repeat(np.arange(len(a)), many)
        line = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        edge.append(row)
        t.append((line - ga[row, axis]) / (gb[row, axis] - ga[row, axis]))
    edge, t = np.concatenate(edge), np.concatenate(t)
    order = np.lexsort((t, edge))
    edge, t = edge[order], t[order]
    at = a[edge] + t[:, None] * (b - a)[edge]
    same = edge[1:] == edge[:-1]
    p, r = at[:-1][same], at[1:][same]
    middle = ((p + r) / 2 - start) / step
    return np.floor(middle[:, 1]).astype(int), np.floor(middle[:, 0]).astype(int), np.stack([p[:, 0], authalic_number(p[:, 1]), r[:, 0], authalic_number(r[:, 1])], axis=1)


def cell_areas(rings: list[np.ndarray], grid: Grid, first: int, last: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Rows first to last of the grid: the first column that the polygon meets, and the areas of its overlaps from there on.

    Every piece of an edge adds the area between it and its cell's west side to its
    own cell and a whole cell's width to the cells further west in its row, so a
    running sum from the east gives all overlaps: cells inside are never clipped.
    The first ring is counted once as positive, the others (holes) as negative.
    """
    parts = []
    for k, ring in enumerate(rings):
        turn = np.sign((ring[:, 0] * np.roll(ring[:, 1], -1) - np.roll(ring[:, 0], -1) * ring[:, 1]).sum())
        i, j, e = _pieces(ring, grid)
        held = (i >= first) & (i <= last) & (j >= 0)
        parts.append((i[held], np.minimum(j[held], grid.columns), e[held], np.full(held.sum(), turn if k == 0 else -turn)))
    i, j, e, sign = (np.concatenate(x) for x in zip(*parts, strict=True))
    west = max(0, min((int(np.floor((r[:, 0].min() - grid.west) / grid.dlon)) for r in rings), default=0))
    wide = max(0, int(j.max(initial=-1)) + 1 - west)
    dq = sign * (e[:, 3] - e[:, 1])
    cover, own = np.zeros((last - first + 1, wide + 1)), np.zeros((last - first + 1, wide + 1))
    np.add.at(cover, (i - first, j - west), dq)
    np.add.at(own, (i - first, j - west), dq * ((e[:, 0] + e[:, 2]) / 2 - (grid.west + j * grid.dlon)))
    beyond = np.cumsum(cover[:, ::-1], axis=1)[:, ::-1] - cover
    area = (own + beyond * grid.dlon)[:, : max(0, min(wide, grid.columns - west))]
    rows = np.arange(first, last + 1)
    cell = grid.dlon * (authalic_number(grid.south + (rows + 1) * grid.dlat) - authalic_number(grid.south + rows * grid.dlat))
    return area, west, cell


#: Grid rows of a polygon in one task.
STRIP = 256


def polygon_overlaps(polygons: DataFrame, grid: Grid, key: str) -> DataFrame:
    """overlap of general polygons, rings array<array<struct<x,y>>> (the first outer, the rest holes).

    A task holds a polygon and STRIP rows of the grid; its work grows with the
    edges, the grid lines that they cross and the cells, not with their product.
    """
    ends = F.flatten("rings")
    low, high = (f(F.transform(ends, lambda p: p["y"])) for f in (F.array_min, F.array_max))
    at = lambda y: F.floor((y - grid.south) / grid.dlat).cast("int")
    first, last = F.greatest(at(low), F.lit(0)), F.least(at(high), F.lit(grid.rows - 1))
    boxed = polygons.select(key, "rings", first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    strips = boxed.withColumn("_strip", F.explode(F.sequence(F.col("_first"), F.col("_last"), F.lit(STRIP))))
    rows = strips.select(key, "rings", F.col("_strip").alias("_first"), F.least(F.col("_strip") + (STRIP - 1), "_last").alias("_last"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rings = [np.array([(p["x"], p["y"]) for p in r], float) for r in batch["rings"][k].as_py() if r]
                begin = batch["_first"][k].as_py()
                area, west, cell = cell_areas(rings, grid, begin, batch["_last"][k].as_py())
                i, j = np.nonzero(area > 1e-15)
                told = [batch[key].take(pa.array(np.full(len(i), k))), pa.array((i + begin).astype(np.int32)), pa.array((j + west).astype(np.int32)), pa.array(area[i, j] / cell[i])]
                yield pa.RecordBatch.from_arrays(told, names=[key, "lat_idx", "lon_idx", "overlap"])

    return rows.mapInArrow(work, f"`{key}` {dict(polygons.dtypes)[key]}, lat_idx int, lon_idx int, overlap double")


def bilinear_weights(targets: DataFrame, grid: Grid) -> DataFrame:
    """Up to four source cells and weights for each target (target_id, lat, lon), by cell centres."""
    y, x = (F.col("lat") - grid.south) / grid.dlat - 0.5, (F.col("lon") - grid.west) / grid.dlon - 0.5
    base = targets.withColumns({"_i": F.floor(y).cast("int"), "_j": F.floor(x).cast("int"), "_v": y - F.floor(y), "_u": x - F.floor(x)})
    corner = lambda di, dj: F.struct((F.col("_i") + di).alias("lat_idx"), (F.col("_j") + dj).alias("lon_idx"), ((F.col("_v") if di else 1 - F.col("_v")) * (F.col("_u") if dj else 1 - F.col("_u"))).alias("weight"))
    four = base.select("target_id", F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))).alias("c")).select("target_id", "c.*")
    inside = F.col("lat_idx").between(0, grid.rows - 1) & F.col("lon_idx").between(0, grid.columns - 1)
    return four.filter(inside & (clip("weight", 0.0) > 1e-12))


def with_monthly(df: DataFrame, climate: DataFrame, grid: Grid, name: str, default: float | None = None, time: str = "time") -> DataFrame:
    """name: the value of a monthly raster (lat_idx, lon_idx, month, name) at each row's place and day, between the middles of months.

    Rows (lat, lon, time) meet the raster's cells by index arithmetic and one
    equi-join; a cell's months are one array.  Rows outside the raster, or between
    months of which one is missing, take the default.
    """
    months = climate.groupBy("lat_idx", "lon_idx").agg(F.map_from_entries(F.collect_list(F.struct("month", name))).alias("_by"))
    table = months.select(F.col("lat_idx").alias("_r"), F.col("lon_idx").alias("_c"), F.array(*[F.col("_by")[F.lit(m)] for m in range(1, 13)]).alias("_monthly"))
    at = df.withColumns({"_r": F.floor((F.col("lat") - grid.south) / grid.dlat).cast("int"), "_c": F.floor((F.col("lon") - grid.west) / grid.dlon).cast("int")})
    small = F.broadcast(table) if table.count() <= BROADCAST_WEIGHTS else table
    value = monthly_at(F.dayofyear(time), F.col("_monthly"))
    return at.join(small, ["_r", "_c"], "left").withColumn(name, value if default is None else F.coalesce(value, F.lit(default))).drop("_r", "_c", "_monthly")


def curvilinear_weights(targets: DataFrame, centres: DataFrame, step: float | None = None) -> DataFrame:
    """Four source cells (y, x) and weights for each target (target_id, lat, lon) in a grid whose centres (y, x, lat, lon) lie anywhere.

    Each quadrilateral of neighbouring centres is posted to the squares of ``step``
    degrees that its box meets, and targets look in their own square, so both meet
    by an equi-join.  In a quadrilateral the position (u, v) solves a quadratic
    equation.  A target on a common edge takes the quadrilateral that comes first;
    one outside of all has no rows.  ``step`` is by default the mean size of the
    quadrilaterals, from one pass over them.
    """
    corner = lambda dy, dx, name: centres.select((F.col("y") - dy).alias("y"), (F.col("x") - dx).alias("x"), F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias(name))
    quads = corner(0, 0, "a").join(corner(0, 1, "b"), ["y", "x"]).join(corner(1, 0, "c"), ["y", "x"]).join(corner(1, 1, "d"), ["y", "x"])
    for side, f, axis in (("west", F.least, "x"), ("east", F.greatest, "x"), ("south", F.least, "y"), ("north", F.greatest, "y")):
        quads = quads.withColumn(side, f(*[F.col(f"{p}.{axis}") for p in "abcd"]))
    if step is None:
        mean = quads.agg(F.avg(F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))).alias("s")).first()["s"]
        step = mean or 1.0
    square = lambda c: F.floor(c / step)
    posted = quads.withColumn("_i", F.explode(F.sequence(square(F.col("west")), square(F.col("east"))))).withColumn("_j", F.explode(F.sequence(square(F.col("south")), square(F.col("north")))))
    asked = targets.select("target_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), square(F.col("lon")).alias("_i"), square(F.col("lat")).alias("_j"))
    near = asked.join(posted, ["_i", "_j"]).filter(F.col("_lon").between(F.col("west") - SLIVER, F.col("east") + SLIVER) & F.col("_lat").between(F.col("south") - SLIVER, F.col("north") + SLIVER))

    def part(name: str) -> tuple[Column, Column]:
        return F.col(f"{name}.x"), F.col(f"{name}.y")

    (ax, ay), (bx, by), (cx, cy), (dx, dy) = (part(p) for p in "abcd")
    # target = a + u e + v f + u v g
    ex, ey, fx, fy, gx, gy = bx - ax, by - ay, cx - ax, cy - ay, ax - bx - cx + dx, ay - by - cy + dy
    hx, hy = F.col("_lon") - ax, F.col("_lat") - ay
    k2, k1, k0 = gx * fy - gy * fx, ex * fy - ey * fx + hx * gy - hy * gx, hx * ey - hy * ex
    near = near.withColumns({"_k2": k2, "_k1": k1, "_k0": k0})
    root = F.sqrt(F.greatest(F.col("_k1") * F.col("_k1") - 4 * F.col("_k0") * F.col("_k2"), F.lit(0.0)))
    # the form without cancellation, which also holds where the quadratic term is nothing
    q = -0.5 * (F.col("_k1") + F.when(F.col("_k1") < 0, -root).otherwise(root))
    solved = near.withColumn("_v", F.explode(F.array(ratio(F.col("_k0"), q), F.when(F.abs("_k2") > 1e-14, ratio(q, F.col("_k2"))))))
    across, up = ex + F.col("_v") * gx, ey + F.col("_v") * gy
    u = F.when(F.abs(across) > F.abs(up), ratio(hx - F.col("_v") * fx, across)).otherwise(ratio(hy - F.col("_v") * fy, up))
    inside = solved.withColumn("_u", u).filter(F.col("_u").between(-SLIVER, 1 + SLIVER) & F.col("_v").between(-SLIVER, 1 + SLIVER))
    first = inside.groupBy("target_id").agg(F.min(F.struct("y", "x", F.col("_u").alias("u"), F.col("_v").alias("v"))).alias("q"))
    u, v = clip(F.col("q.u"), 0.0, 1.0), clip(F.col("q.v"), 0.0, 1.0)
    four = F.array(*[
        F.struct((F.col("q.y") + down).alias("y"), (F.col("q.x") + right).alias("x"), ((v if down else 1 - v) * (u if right else 1 - u)).alias("weight"))
        for down in (0, 1) for right in (0, 1)
    ])
    return first.select("target_id", F.explode(four).alias("w")).select("target_id", "w.*").filter("weight > 1e-12")


def regrid_curvilinear(cells: DataFrame, targets: DataFrame, centres: DataFrame, values: list[str], time: str = "time", step: float | None = None) -> DataFrame:
    """Bilinear values at targets from cells (y, x, time, values) of a curvilinear grid; a target that lacks a source value has none."""
    weights = curvilinear_weights(targets, centres, step)
    joined = cells.join(F.broadcast(weights) if weights.count() <= BROADCAST_WEIGHTS else weights, ["y", "x"])
    made = [F.when(F.abs(F.sum(F.when(F.col(v).isNotNull(), F.col("weight"))) - 1) < 1e-9, F.sum(F.col(v) * F.col("weight"))).alias(v) for v in values]
    return joined.groupBy("target_id", time).agg(*made)


def regular_targets(spark: SparkSession, box: BoundingBox, step: float) -> DataFrame:
    """target_id, lat, lon of a regular grid from the box's south-west corner up to, but without, its north and east sides."""
    rows, columns = (math.ceil(round((b - a) / step, 9)) for a, b in ((box.south, box.north), (box.west, box.east)))
    ids = spark.range(rows * columns)
    return ids.select(F.col("id").alias("target_id"), (box.south + F.floor(F.col("id") / columns) * step).alias("lat"), (box.west + F.col("id") % columns * step).alias("lon"))


def lambert_forward(lat: Column, lon: Column, lat_1: float = 50.0, lat_2: float = 50.0, lat_0: float = 50.0, lon_0: float = -107.0, radius: float = 6_371_229.0) -> tuple[Column, Column]:
    """x and y of the spherical Lambert conformal conic projection."""
    n, f, origin = _lambert(lat_1, lat_2, lat_0, radius)
    rho = f / F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), n)
    theta = n * F.radians(wrap_longitude(lon - lon_0))
    return rho * F.sin(theta), origin - rho * F.cos(theta)


def regrid(cells: DataFrame, targets: DataFrame, grid: Grid, values: list[str], time: str = "time") -> DataFrame:
    """Bilinear values at targets (target_id, lat, lon) from a regular grid; a target that lacks a source value has none."""
    joined = with_weights(cells, bilinear_weights(targets, grid))
    made = [F.when(F.abs(F.sum(F.when(F.col(v).isNotNull(), F.col("weight"))) - 1) < 1e-9, F.sum(F.col(v) * F.col("weight"))).alias(v) for v in values]
    return joined.groupBy("target_id", time).agg(*made)


def on_conformal(targets: DataFrame, **projection: float) -> DataFrame:
    """Targets (target_id, lat, lon) with the projected y and x in place of lat and lon, for weights on a conformal grid."""
    x, y = lambert_forward(F.col("lat"), F.col("lon"), **projection)
    return targets.select("target_id", y.alias("lat"), x.alias("lon"))


def clip_conformal(cells: DataFrame, box: BoundingBox, **projection: float) -> DataFrame:
    """Cells (x, y in metres) in the projected rectangle that holds the box's corners and edge middles."""
    lats, lons = (box.south, (box.south + box.north) / 2, box.north), (box.west, (box.west + box.east) / 2, box.east)
    xs, ys = zip(*[lambert_point(a, b, **projection) for a in lats for b in lons], strict=True)
    return cells.filter(F.col("x").between(min(xs), max(xs)) & F.col("y").between(min(ys), max(ys)))


def lambert_point(lat: float, lon: float, lat_1: float = 50.0, lat_2: float = 50.0, lat_0: float = 50.0, lon_0: float = -107.0, radius: float = 6_371_229.0) -> tuple[float, float]:
    """``lambert_forward`` of one point."""
    n, f, origin = _lambert(lat_1, lat_2, lat_0, radius)
    rho = f / math.tan(math.pi / 4 + math.radians(lat) / 2) ** n
    theta = n * math.radians((lon - lon_0 + 180) % 360 - 180)
    return rho * math.sin(theta), origin - rho * math.cos(theta)


def _lambert(lat_1: float, lat_2: float, lat_0: float, radius: float) -> tuple[float, float, float]:
    """Cone constant, scaled radius and the origin's distance from the pole."""
    p1, p2, p0 = (math.radians(v) for v in (lat_1, lat_2, lat_0))
    half = lambda p: math.tan(math.pi / 4 + p / 2)
    n = math.sin(p1) if abs(p1 - p2) < 1e-12 else math.log(math.cos(p1) / math.cos(p2)) / math.log(half(p2) / half(p1))
    f = radius * math.cos(p1) * half(p1) ** n / n
    return n, f, f / half(p0) ** n
