"""Queries of the binary formats, the geometry and the name maps of gridded sources."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions import radiation as rad
from isohyet.operators import cascade as cas
from isohyet.operators import geometry as geo
from isohyet.operators import legacy, olsson
from isohyet.operators import spatial as sp
from isohyet.operators import store
from isohyet.operators import time as ti
from isohyet.plans.catalogue import BOX, OVERLAPS, SUN, _parameters, authalic, cascade_sql, ineichen, sun
from isohyet.plans.feeds import FRACTIONS, HOUR, OBSERVED, TARGETS, _dsn_rows, _lines, _observed, _targets
from isohyet.plans.registry import ORACLE, query
from isohyet.plans.views import GRID, ctes, fine, view
from isohyet.sources import canonical, chunked, decode, gridded, stations, vector

# --- binary granules ------------------------------------------------------------------------------------

MONTH = "strftime(time, '%Y%m')"


def _granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path and content: the cells of a month as one classic NetCDF file."""
    cells = view(spark, sf_dir, "cells").withColumn("month", F.date_format("time", "yyyyMM"))
    made = decode.encode_grids(cells, ["month"], ["tair_k", "rainf"])
    return made.select(F.concat(F.lit("cells_"), "month", F.lit("01.nc")).alias("path"), "content")


@query(
    "netcdf_granules",
    f"""{ctes('cells')}, t AS (UNPIVOT (SELECT time, lat, lon, tair_k, rainf FROM cells WHERE lat BETWEEN 44.55e0 AND 45.05e0 AND lon BETWEEN -95.02e0 AND -94.13e0) ON tair_k, rainf INTO NAME variable VALUE value)
SELECT variable, time, round(lat, 6) AS lat, round(lon, 6) AS lon, round(max(value), 6) AS value FROM t WHERE variable IN ('tair_k', 'rainf') GROUP BY 1, 2, 3, 4""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode.decode(_granules(spark, sf_dir), decode.Window(("tair_k", "rainf"), BOX), drop_missing=True)
    return rows.select("variable", "time", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "value")])


@query(
    "granule_errors",
    f"""{ctes('cells')}, f AS (SELECT {MONTH} AS month, CAST({MONTH} AS INT) % 3 AS kind FROM cells GROUP BY 1),
r AS (SELECT {MONTH} AS month, count(DISTINCT (time, lat, lon)) AS n FROM cells WHERE rainf IS NOT NULL GROUP BY 1)
SELECT 'cells_' || month || '01.nc' AS path, kind < 2 AS bad, CASE WHEN kind = 2 THEN n ELSE 0 END AS n FROM f JOIN r USING (month)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the months some are cut short and some are no NetCDF: errors by path, and rows of the files that are whole."""
    kind = F.substring("path", 7, 6).cast("int") % 3
    cut = F.expr("substring(content, 1, CAST(length(content) / 2 AS INT))")
    broken = _granules(spark, sf_dir).withColumn("content", F.when(kind == 0, cut).when(kind == 1, F.expr("substring(content, 5)")).otherwise(F.col("content")))
    good, bad = decode.split_errors(decode.decode(broken, decode.Window(("rainf",)), drop_missing=True))
    whole = good.groupBy("path").agg(F.count(F.lit(1)).alias("n")).withColumn("bad", F.lit(False))
    return whole.unionByName(bad.groupBy("path").agg(F.lit(0).cast("long").alias("n"), F.lit(True).alias("bad")))


# --- curvilinear grids ----------------------------------------------------------------------------------

TURN, SIZE = 0.3, 0.07


@query(
    "regrid_curvilinear",
    f"""{ctes('cells')}, {TARGETS}, b AS (SELECT *, ((lon + 96e0) * cos({TURN}e0) + (lat - 44e0) * sin({TURN}e0)) / {SIZE}e0 AS x, ((lat - 44e0) * cos({TURN}e0) - (lon + 96e0) * sin({TURN}e0)) / {SIZE}e0 AS y FROM t),
c AS (SELECT target_id, CAST(floor(y) AS INT) + di AS lat_idx, CAST(floor(x) AS INT) + dj AS lon_idx, (CASE WHEN di = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dj = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS weight
  FROM b, (VALUES (0), (1)) p(di), (VALUES (0), (1)) r(dj) WHERE x BETWEEN 0 AND 29 AND y BETWEEN 0 AND 19),
g AS (SELECT lat_idx, lon_idx, CAST(date_trunc('year', time) AS TIMESTAMP) AS time, avg(tair_k) AS v FROM cells WHERE (lat_idx + lon_idx) % 11 > 0 GROUP BY 1, 2, 3)
SELECT target_id, time, round(CASE WHEN abs(sum(weight) - 1) < 1e-9 THEN sum(v * weight) END, 5) AS v FROM g JOIN c USING (lat_idx, lon_idx) WHERE weight > 1e-12 GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells as a grid that is turned by 0.3 radians, its centres given as latitudes and longitudes."""
    cells = view(spark, sf_dir, "cells").filter("(lat_idx + lon_idx) % 11 > 0")
    grids = cells.groupBy(F.col("lat_idx").alias("y"), F.col("lon_idx").alias("x"), ti.period_start(F.col("time"), "year").alias("time")).agg(F.avg("tair_k").alias("v"))
    s, c = math.sin(TURN), math.cos(TURN)
    at = spark.range(GRID.rows * GRID.columns).select((F.col("id") / GRID.columns).cast("int").alias("y"), (F.col("id") % GRID.columns).cast("int").alias("x"))
    centres = at.select("y", "x", (44.0 + SIZE * (F.col("x") * s + F.col("y") * c)).alias("lat"), (-96.0 + SIZE * (F.col("x") * c - F.col("y") * s)).alias("lon"))
    return sp.regrid_curvilinear(grids, _targets(spark, sf_dir), centres, ["v"]).select("target_id", "time", F.round("v", 5).alias("v"))


# --- polygons with geometry -----------------------------------------------------------------------------

AREA = "(least(a.east, b.east) - greatest(a.west, b.west)) * (" + authalic("least(a.north, b.north)") + " - " + authalic("greatest(a.south, b.south)") + ")"


def _rings(df: DataFrame) -> DataFrame:
    """Rectangles as rings."""
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return df.withColumn("rings", F.array(F.array(point("west", "south"), point("east", "south"), point("east", "north"), point("west", "north"))))


@query(
    "polygon_overlay",
    f"""{ctes('polygons', 'stations')}, b AS (SELECT station, lat - 0.13e0 AS south, lat + 0.13e0 AS north, lon - 0.17e0 AS west, lon + 0.17e0 AS east FROM stations)
SELECT polygon_index, station, round({AREA}, 6) AS area FROM polygons a JOIN b ON least(a.east, b.east) - greatest(a.west, b.west) > 1e-6 AND least(a.north, b.north) - greatest(a.south, b.south) > 1e-6""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = view(spark, sf_dir, "stations").select(
        "station", (F.col("lat") - 0.13).alias("south"), (F.col("lat") + 0.13).alias("north"), (F.col("lon") - 0.17).alias("west"), (F.col("lon") + 0.17).alias("east")
    )
    left, right = _rings(view(spark, sf_dir, "polygons")).select("polygon_index", "rings"), _rings(around).select("station", "rings")
    return geo.overlay(left, right, "polygon_index", "station", 0.25).select("polygon_index", "station", F.round("area", 6).alias("area"))


@query(
    "dissolve_geometry",
    f"""{ctes('polygons')}, xs AS (SELECT metzone, x, lead(x) OVER (PARTITION BY metzone ORDER BY x) AS x1 FROM (SELECT metzone, west AS x FROM polygons UNION SELECT metzone, east FROM polygons)),
ys AS (SELECT metzone, y, lead(y) OVER (PARTITION BY metzone ORDER BY y) AS y1 FROM (SELECT metzone, south AS y FROM polygons UNION SELECT metzone, north FROM polygons))
SELECT metzone, round(sum((x1 - x) * ({authalic('y1')} - {authalic('y')})), 6) AS area FROM xs JOIN ys USING (metzone)
WHERE EXISTS (SELECT 1 FROM polygons p WHERE p.metzone = xs.metzone AND p.west <= x AND p.east >= x1 AND p.south <= y AND p.north >= y1) GROUP BY 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones are unions: their areas count what several polygons cover once."""
    made = geo.dissolve_rings(_rings(view(spark, sf_dir, "polygons")), "metzone", "polygon_index")
    return made.select("metzone", F.round("area", 6).alias("area"))


@query("overlay_fractions", f"{ctes('polygons')}, {FRACTIONS} SELECT polygon_index, lat_idx, lon_idx, round(fraction, 6) AS fraction FROM fractions WHERE fraction > 1e-7")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of each region by cell from an overlay of the cells' own polygons with the regions."""
    cells = sp.generate_grid(spark, sp.BoundingBox(GRID.west, GRID.south, GRID.west + GRID.columns * GRID.dlon, GRID.south + GRID.rows * GRID.dlat), GRID.dlat)
    left = _rings(cells).select((F.col("row_id") * GRID.columns + F.col("column_id")).alias("cell"), "rings")
    met = geo.overlay(left, _rings(view(spark, sf_dir, "polygons")).select("polygon_index", "rings"), "cell", "polygon_index", 0.25)
    placed = met.select("polygon_index", F.floor(F.col("cell") / GRID.columns).cast("int").alias("lat_idx"), (F.col("cell") % GRID.columns).alias("lon_idx"), F.col("area").alias("overlap_area"))
    return sp.region_fractions(placed, "polygon_index").filter("fraction > 1e-7").withColumn("fraction", F.round("fraction", 6))


@query("geojson_weights", f"{ctes('polygons')}, {OVERLAPS} SELECT CAST(polygon_index AS VARCHAR) AS polygon, lat_idx, lon_idx, round(area / cell, 5) AS overlap FROM over")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature collection of each zone as text, parsed to polygons and laid over the grid."""
    point = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(point("west", "south"), point("east", "south"), point("east", "north"), point("west", "north"), point("west", "south"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("polygon_index").cast("string").alias("polygon")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    texts = view(spark, sf_dir, "polygons").groupBy("metzone").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("json"))
    made = sp.polygon_overlaps(stations.geojson_polygons(texts, "json", "polygon"), GRID, "polygon")
    return made.filter("overlap > 1e-7").select("polygon", "lat_idx", "lon_idx", F.round("overlap", 5).alias("overlap"))


@query("chunked_window", ORACLE["netcdf_granules"].replace("WHERE variable IN", "WHERE value IS NOT NULL AND variable IN"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells as a chunked store, of which only chunks that meet a box are read back."""
    made, chunks = chunked.encode_store(view(spark, sf_dir, "cells").select("time", "lat", "lon", "tair_k", "rainf"), ["tair_k", "rainf"], (168, 8, 8))
    rows = made.rows(chunks, decode.Window(("tair_k", "rainf"), BOX), drop_missing=True)
    return rows.select("variable", "time", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "value")])


# --- vector files of catchments -------------------------------------------------------------------------

#: Two systems in which catchment files come: a zone of the transverse Mercator grid, and a state's cone in survey feet.
MAPS = (
    "EPSG:26915",
    'PROJCS["South",GEOGCS["NAD83",DATUM["North_American_Datum_1983",SPHEROID["GRS 1980",6378137,298.257222101]],UNIT["degree",0.0174532925199433]],'
    'PROJECTION["Lambert_Conformal_Conic_2SP"],PARAMETER["standard_parallel_1",45.2166666667],PARAMETER["standard_parallel_2",43.7833333333],PARAMETER["latitude_of_origin",43],'
    'PARAMETER["central_meridian",-94],PARAMETER["false_easting",2624666.667],PARAMETER["false_northing",328083.333],UNIT["US survey foot",0.304800609601219]]',
)


def _shapefiles(spark: SparkSession, sf_dir: str, crs: str) -> DataFrame:
    """path and content: the polygons of a zone as one shapefile, in a projected system."""
    rows = _rings(view(spark, sf_dir, "polygons")).withColumnRenamed("polygon_index", "polygon")
    return vector.encode_shapefiles(rows, "metzone", ["metzone", "polygon"], crs)


@query("shapefile_corners", f"{ctes('polygons')} SELECT CAST(polygon_index AS VARCHAR) AS polygon, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north FROM polygons")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the polygons of shapefiles in feet on a cone, moved to longitude and latitude."""
    made = geo.boxed(vector.decode(_shapefiles(spark, sf_dir, MAPS[1])))
    return made.select(F.col("properties")["polygon"].alias("polygon"), *[F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")])


@query("shapefile_zones", ORACLE["dissolve_geometry"].replace("SELECT metzone, round(sum(", "SELECT CAST(metzone AS VARCHAR) AS metzone, round(sum("))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as unions of the catchments of all shapefiles, moved from their own system."""
    made = vector.polygons(_shapefiles(spark, sf_dir, MAPS[0]), "metzone")
    return made.select("metzone", F.round("area", 6).alias("area"))


@query(
    "vector_errors",
    f"{ctes('polygons')} SELECT metzone || '.shp' AS path, count(*) AS features, false AS failed FROM polygons GROUP BY 1 UNION ALL SELECT DISTINCT 'x' || metzone || '.shp', CAST(0 AS BIGINT), true FROM polygons",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by file; files without a coordinate system are rows of errors."""
    good = _shapefiles(spark, sf_dir, MAPS[0])
    bare = good.filter(~F.col("path").endswith(".prj")).withColumn("path", F.concat(F.lit("x"), "path"))
    told = vector.decode(good.unionByName(bare))
    return told.groupBy("path").agg(F.count("feature").alias("features"), F.bool_or(F.col("error").isNotNull()).alias("failed"))


# --- names and units of further sources -----------------------------------------------------------------


@query("aorc_variables", f"{ctes('cells')} SELECT l_orderkey, l_linenumber, round(tair_k - 273.15e0, 6) AS temperature_c, qair AS specific_humidity_kgkg, round(sqrt(wind_e * wind_e + wind_n * wind_n), 6) AS wind_speed_ms, rainf AS precip_mm FROM cells WHERE lat BETWEEN 44.55e0 - {1 / 240!r}e0 AND 45.05e0 + {1 / 240!r}e0 AND lon BETWEEN -95.02e0 - {1 / 240!r}e0 AND -94.13e0 + {1 / 240!r}e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, box and units of the hourly 1 km source; columns and the box reach the scan."""
    names = {"tair_k": "TMP_2maboveground", "qair": "SPFH_2maboveground", "wind_e": "UGRD_10maboveground", "wind_n": "VGRD_10maboveground", "rainf": "APCP_surface"}
    step = canonical.RESOLUTION["aorc"]
    raw = sp.clip_grid(view(spark, sf_dir, "cells"), BOX, step, step).withColumnsRenamed(names)
    made = canonical.canonical(raw, "aorc", ("l_orderkey", "l_linenumber"))
    return made.select("l_orderkey", "l_linenumber", F.round("temperature_c", 6).alias("temperature_c"), "specific_humidity_kgkg", F.round("wind_speed_ms", 6).alias("wind_speed_ms"), "precip_mm")


@query("narr_merge", f"""{ctes('cells')}, g AS (SELECT lat_idx AS y, lon_idx AS x, CAST(date_trunc('day', time) AS TIMESTAMP) AS time, avg(tair_k) AS a, max(qair) * 1e4 AS c FROM cells GROUP BY 1, 2, 3),
p AS (SELECT lat_idx AS y, lon_idx AS x, CAST(date_trunc('day', time) AS TIMESTAMP) AS time, max(rainf) AS p FROM cells WHERE l_orderkey % 3 > 0 GROUP BY 1, 2, 3)
SELECT time, y, x, round(a - 273.15e0, 5) AS temperature_c, round(p, 6) AS precip_mm, round(c / 1e2, 6) AS cloud_cover FROM g LEFT JOIN p USING (y, x, time)""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per variable, merged on the shared grid in one grouping of tidy rows, then names and units."""
    cells = view(spark, sf_dir, "cells").select(F.col("lat_idx").alias("y"), F.col("lon_idx").alias("x"), ti.period_start(F.col("time")).alias("time"), "tair_k", "qair", "rainf", "l_orderkey")
    files = {"air": ("tair_k", F.avg("tair_k"), "true"), "tcdc": ("qair", F.max("qair") * 10000.0, "true"), "apcp": ("rainf", F.max("rainf"), "l_orderkey % 3 > 0")}
    parts = [cells.filter(where).groupBy("y", "x", "time").agg(made.alias("value")).withColumn("variable", F.lit(v)) for v, (_, made, where) in files.items()]
    tidy = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = gridded.wide(tidy.withColumnsRenamed({"y": "lat", "x": "lon"}), list(files)).withColumnsRenamed({"lat": "y", "lon": "x"})
    made = canonical.canonical(merged, "narr", ("time", "y", "x"))
    return made.select("time", "y", "x", F.round("temperature_c", 5).alias("temperature_c"), F.round("precip_mm", 6).alias("precip_mm"), F.round("cloud_cover", 6).alias("cloud_cover"))


@query("release_records", """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_date, CASE WHEN o_orderkey % 5 > 0 THEN CAST(CAST(o_orderdate + INTERVAL 2 DAY AS DATE) AS VARCHAR) END AS release_date, 'ppt' AS element, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_custkey AS INT) ELSE -1 END AS grid_count FROM orders""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release record of each order as JSON text, some with values that are no dates or numbers."""
    day = F.to_date("o_orderdate")
    texts = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_json(F.struct(
        day.cast("string").alias("data_date"), F.when(F.col("o_orderkey") % 5 > 0, F.date_add(day, 2).cast("string")).otherwise("pending").alias("release_date"), F.lit("ppt").alias("element"),
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_custkey").cast("string")).otherwise("n/a").alias("grid_count"),
    )).alias("json"))
    made = gridded.prism_release(texts)
    return made.select(F.col("data_date").cast("string").alias("data_date"), F.col("release_date").cast("string").alias("release_date"), "element", F.coalesce("grid_count", F.lit(-1)).alias("grid_count"))


# --- turbidity ------------------------------------------------------------------------------------------

HAZE = "SELECT CAST(floor(lat_idx / 5e0) AS INT) AS lat_idx, CAST(floor(lon_idx / 5e0) AS INT) AS lon_idx, CAST(month(time) AS INT) AS month, 2e0 + 2e1 * avg(qair) AS turbidity FROM cells GROUP BY 1, 2, 3"
MIDDLES = f"(VALUES {', '.join(f'({k + 1}, {m!r}e0)' for k, m in enumerate(rad.MONTH_MIDDLES))}) m(month, middle)"


@query(
    "clearsky_turbidity",
    f"""{ctes('cells')}, h AS ({HAZE}), m AS (SELECT * FROM {MIDDLES}), e AS (SELECT *, {SUN} AS sun, CAST(dayofyear(time) AS DOUBLE) AS d FROM cells),
b AS (SELECT *, coalesce((SELECT max(month) FROM m WHERE middle <= e.d), 12) AS m0 FROM e),
t AS (SELECT b.*, b.m0 % 12 + 1 AS m1, a.middle - CASE WHEN a.middle > b.d THEN 365e0 ELSE 0e0 END AS x0 FROM b JOIN m a ON a.month = b.m0),
i AS (SELECT t.*, h0.turbidity AS t0, h1.turbidity AS t1, c.middle + CASE WHEN c.middle <= t.x0 THEN 365e0 ELSE 0e0 END AS x1 FROM t JOIN m c ON c.month = t.m1
  LEFT JOIN h h0 ON h0.lat_idx = CAST(floor(t.lat_idx / 5e0) AS INT) AND h0.lon_idx = CAST(floor(t.lon_idx / 5e0) AS INT) AND h0.month = t.m0
  LEFT JOIN h h1 ON h1.lat_idx = CAST(floor(t.lat_idx / 5e0) AS INT) AND h1.lon_idx = CAST(floor(t.lon_idx / 5e0) AS INT) AND h1.month = t.m1),
f AS (SELECT *, coalesce(t0 + (t1 - t0) * (d - x0) / (x1 - x0), 3e0) AS haze FROM i)
SELECT l_orderkey, l_linenumber, round(haze, 6) AS turbidity, round({ineichen('sun', 'haze')}, 5) AS clearsky FROM f""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clear sky under a turbidity raster by month on a grid five times as coarse."""
    cells = view(spark, sf_dir, "cells")
    coarse = sp.Grid(GRID.south, GRID.west, 5 * GRID.dlat, 5 * GRID.dlon, GRID.rows // 5, GRID.columns // 5)
    fifth = lambda c: F.floor(F.col(c) / 5).cast("int").alias(c)
    climate = cells.groupBy(fifth("lat_idx"), fifth("lon_idx"), F.month("time").alias("month")).agg((2.0 + 20.0 * F.avg("qair")).alias("turbidity"))
    made = sp.with_monthly(cells.withColumn("sun", sun()), climate, coarse, "turbidity", default=rad.CLEAR_TURBIDITY)
    return made.select("l_orderkey", "l_linenumber", F.round("turbidity", 6).alias("turbidity"), F.round(rad.clearsky_ineichen("sun", F.col("time"), F.col("turbidity")), 5).alias("clearsky"))


# --- cascades -------------------------------------------------------------------------------------------


@query(
    "olsson_statistics",
    f"""{ctes('fine_gaps')}, st AS (SELECT zone, CAST(floor(epoch(time) / 3600) AS BIGINT) AS tick, precip_mm AS v FROM fine_gaps WHERE precip_mm > 0),
h AS (SELECT zone, level, CAST(floor(tick / pow(2e0, level)) AS BIGINT) AS box, sum(CASE WHEN CAST(floor(tick / pow(2e0, level - 1)) AS BIGINT) % 2 = 0 THEN v ELSE 0e0 END) AS a, sum(CASE WHEN CAST(floor(tick / pow(2e0, level - 1)) AS BIGINT) % 2 = 1 THEN v ELSE 0e0 END) AS b FROM st, range(1, 6) r(level) GROUP BY 1, 2, 3),
n AS (SELECT *, a + b AS v, coalesce(lag(box) OVER w = box - 1, false) AS wet_before, coalesce(lead(box) OVER w = box + 1, false) AS wet_after FROM h WINDOW w AS (PARTITION BY zone, level ORDER BY box)),
p AS (SELECT *, CASE WHEN wet_before AND wet_after THEN 'enclosed' WHEN wet_after THEN 'starting' WHEN wet_before THEN 'ending' ELSE 'isolated' END AS position FROM n),
c AS (SELECT *, v > avg(v) OVER (PARTITION BY zone, level, position) AS above FROM p)
SELECT zone, position, above, count(*) AS n, round(count(*) FILTER (b <= 0) * 1e0 / count(*), 6) AS first, round(count(*) FILTER (a <= 0) * 1e0 / count(*), 6) AS second,
  {', '.join(f'count(*) FILTER (a > 0 AND b > 0 AND least(floor(a / v * 7), 6) = {k}) AS s{k}' for k in range(7))} FROM c GROUP BY 1, 2, 3""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = olsson.statistics(view(spark, sf_dir, "fine_gaps"), "zone", "precip_mm", step_seconds=3600)
    rounded = [F.round(c, 6).alias(c) for c in ("first", "second")]
    return made.select("zone", "position", "above", "n", *rounded, *[F.get("shares", F.lit(k)).alias(f"s{k}") for k in range(olsson.BINS)])


@query("olsson_hours")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to hours by the statistics of each zone's own hours; tests hold its classes and totals."""
    made = cas.disaggregate_precipitation(_midnight(spark, sf_dir), fine(spark, sf_dir), "zone", "precip_mm", "olsson")
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


def _midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily totals, labelled at midnight."""
    return view(spark, sf_dir, "coarse").withColumn("time", F.col("time") - ti.hours(12))


@query("olsson_totals", f"{ctes('coarse')} SELECT zone, time - INTERVAL 12 HOUR AS time, round(precip_mm, 5) AS total FROM coarse WHERE precip_mm > 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the cascade gives back: each keeps its total."""
    told = olsson.statistics(view(spark, sf_dir, "fine_gaps"), "zone", "precip_mm", step_seconds=3600)
    parts = olsson.cascade(_midnight(spark, sf_dir), "zone", "precip_mm", told)
    return parts.groupBy("zone", "time").agg(F.round(F.sum("value"), 5).alias("total"))


@query(
    "moment_scaling_daily",
    f"""{ctes('coarse')}, d AS (SELECT z.zone, h.time, coalesce(c.precip_mm, 0e0) AS precip_mm FROM (SELECT DISTINCT zone FROM coarse) z CROSS JOIN (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS time FROM (SELECT min(time) AS a, max(time) AS b FROM coarse)) h LEFT JOIN coarse c ON c.zone = z.zone AND c.time = h.time),
p AS (SELECT zone, precip_mm, row_number() OVER (PARTITION BY zone ORDER BY time) - 1 AS p, count(*) OVER (PARTITION BY zone) AS n FROM d),
s AS (SELECT zone, s, CAST(floor(p / pow(2e0, s)) AS BIGINT) AS g, sum(precip_mm) AS v FROM p, range(6) r(s) WHERE p < n - n % 32 GROUP BY 1, 2, 3),
m AS (SELECT zone, s, q * 0.5e0 AS q, avg(pow(v, q * 0.5e0)) AS m FROM s, range(1, 11) r(q) GROUP BY 1, 2, 3)
SELECT zone, q, round(-regr_slope(ln(m), ln(pow(2e0, 5 - s))), 6) AS tau FROM m WHERE m > 0 GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales of 1 to 32 days of the daily series itself."""
    whole = ti.complete(view(spark, sf_dir, "coarse"), ["zone"], {"precip_mm": 0.0}, step="INTERVAL '1' DAY")
    return cas.moment_scaling(whole, "zone", "precip_mm").select("zone", "q", F.round("tau", 6).alias("tau"))


@query(
    "legacy_cascade",
    f"""{ctes('coarse')}, src AS (SELECT zone, time - INTERVAL 12 HOUR AS time, precip_mm AS value FROM coarse), {cascade_sql('src')}
SELECT d.zone, d.time - INTERVAL 23 HOUR AS time, round(d.value, 6) AS precip_mm FROM drawn d JOIN (SELECT zone, min(time) AS first FROM src GROUP BY 1) f ON f.zone = d.zone WHERE d.time - INTERVAL 23 HOUR >= first""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = legacy.cascade_end_labelled(_midnight(spark, sf_dir), "zone", "precip_mm", _parameters(spark))
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


# --- stores ---------------------------------------------------------------------------------------------


@query("station_store", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS station, {HOUR} + INTERVAL 53 MINUTE AS valid, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS air_temp_f, 'CLR' AS sky_cover_1 FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations through a store that holds half of them; the loader makes the texts of the others."""
    observed = _observed(spark, sf_dir).withColumn("station", F.col("station").cast("string"))

    def load(pairs: DataFrame) -> DataFrame:
        value = F.when(F.col("gone"), "M").otherwise(F.col("t").cast("string"))
        asked = observed.join(pairs.select("station"), "station", "left_semi")
        return _lines(asked, ["#DEBUG: text", "station,valid,tmpf,skyc1"], F.col("station"), F.format_string("2001-06-01 %02d:53", "h"), value, "CLR")

    names, path, day = observed.select("station").distinct(), store.scratch(spark), date(2001, 6, 1)
    stations.fetch(spark, "asos", path, names.filter("station % 2 = 0"), day, day, load)
    return stations.fetch(spark, "asos", path, names, day, day, load).select("station", "valid", "air_temp_f", "sky_cover_1")


@query("network_store", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS stid, {HOUR} AS time, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS air_temp, CAST(h AS DOUBLE) AS wind_speed, CAST(NULL AS DOUBLE) AS pressure FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time series documents of a network through a store that holds a third of its stations; variables that none reports are null."""
    observed = _observed(spark, sf_dir).withColumn("station", F.col("station").cast("string"))

    def load(pairs: DataFrame) -> DataFrame:
        asked = observed.join(pairs.select("station"), "station", "left_semi")
        sorted_rows = asked.groupBy("station").agg(F.array_sort(F.collect_list(F.struct("h", "t", "gone"))).alias("o"))
        held = lambda f: F.transform("o", f)
        series = F.struct(
            held(lambda x: F.format_string("2001-06-01T%02d:00:00Z", x["h"])).alias("date_time"),
            held(lambda x: F.when(~x["gone"], x["t"].cast("string"))).alias("air_temp_set_1"), held(lambda x: x["h"].cast("string")).alias("wind_speed_set_1"),
        )
        return sorted_rows.select(F.to_json(F.struct(F.array(F.struct(F.col("station").alias("STID"), series.alias("OBSERVATIONS"))).alias("STATION"))).alias("json"))

    names, path, day = observed.select("station").distinct(), store.scratch(spark), date(2001, 6, 1)
    stations.fetch(spark, "synoptic_hourly", path, names.filter("station % 3 = 0"), day, day, load)
    return stations.fetch(spark, "synoptic_hourly", path, names, day, day, load).select("stid", "time", "air_temp", "wind_speed", "pressure")


@query(
    "dsn_updated",
    f"""{ctes('fine_gaps', 'coarse')}, z AS (SELECT CAST('10' || zone AS INT) AS dsn, time, precip_mm AS value FROM fine_gaps UNION ALL SELECT CAST('13' || zone AS INT), time, precip_mm FROM coarse),
n AS (SELECT dsn, time + INTERVAL 2 HOUR AS time, value + 1e0 AS value FROM z WHERE dsn % 2 = 0) SELECT dsn, time, round(coalesce(n.value, z.value), 6) AS value FROM z FULL JOIN n USING (dsn, time)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data sets written, half of them updated by rows two hours later, and read back."""
    rows, path = _dsn_rows(spark, sf_dir), store.scratch(spark)
    store.export_dsn(spark, rows, path)
    newer = rows.filter("dsn % 2 = 0").select("dsn", (F.col("time") + ti.hours(2)).alias("time"), (F.col("value") + 1.0).alias("value"))
    store.export_dsn(spark, newer, path, "update")
    return spark.read.parquet(path).select("dsn", "time", F.round("value", 6).alias("value"))


@query("completed_by_step", f"{ctes('coarse')}, s AS (SELECT min(time) AS a, max(time) AS b FROM coarse) SELECT z.zone, h.time, round(coalesce(c.precip_mm, 0e0), 6) AS precip_mm FROM (SELECT DISTINCT zone FROM coarse) z CROSS JOIN (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS time FROM s) h LEFT JOIN coarse c ON c.zone = z.zone AND c.time = h.time")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days by the step of the labels themselves."""
    made = ti.complete(view(spark, sf_dir, "coarse"), ["zone"], {"precip_mm": 0.0}, step=None)
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))
