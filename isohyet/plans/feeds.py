"""Queries of the sources, the legacy variants and the smaller operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions import radiation as rad
from isohyet.operators import disaggregate as dis
from isohyet.operators import legacy
from isohyet.operators import spatial as sp
from isohyet.operators import store
from isohyet.operators import time as ti
from isohyet.plans.catalogue import BOX, DAY, GEOMETRIC, HYBRID, OVERLAPS, WEIGHTED, _hybrid_inputs, _overlaps, _parameters, cascade_sql, lamoreux
from isohyet.plans.registry import query
from isohyet.plans.views import GRID, ctes, fine, view
from isohyet.sources import gridded, stations

# --- station formats: CSV lines, JSON and HTML made from the station view ------------------------------

OBSERVED = "(SELECT station, lat, lon, elevation_m, name, CAST(h AS INT) AS h, (station * 7 + h * 3) % 40 AS t, station % 5 = 0 AS gone FROM stations, range(24) r(h))"
HOUR = "TIMESTAMP '2001-06-01' + INTERVAL 1 HOUR * h"


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations by hour with a value, of which some are missing."""
    rows = view(spark, sf_dir, "stations").withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return rows.withColumns({"t": (F.col("station") * 7 + F.col("h") * 3) % 40, "gone": F.col("station") % 5 == 0})


def _lines(rows: DataFrame, head: list[str], *cells: object) -> DataFrame:
    """Text lines: the head's, then a CSV line per row."""
    said = rows.select(F.concat_ws(",", *[c if not isinstance(c, str) else F.lit(c) for c in cells]).alias("value"))
    return said.unionByName(rows.sparkSession.createDataFrame([(x,) for x in head], "value string"))


_ndawn = lambda rows, hour: _lines(
    rows, ["title", "info", "more", f"Station Name,Latitude,Longitude,Elevation,Year,Month,Day,{'Hour,' if hour is not None else ''}Avg Air Temp", f",deg,deg,ft,,,,{'CST,' if hour is not None else ''}Degrees F"],
    F.col("name"), F.col("lat"), F.col("lon"), F.col("elevation_m"), "2001", "6", "1", *([hour] if hour is not None else []), F.when(F.col("gone"), "M").otherwise(F.col("t").cast("string")),
)


@query("ndawn_hourly", f"{ctes('stations')} SELECT name AS station_name, {HOUR} AS time, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS avg_air_temp FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stations.ndawn_rows(_ndawn(_observed(spark, sf_dir), (F.col("h") + 1) * 100))
    return rows.select("station_name", "time", "avg_air_temp")


@query("ndawn_daily", f"{ctes('stations')} SELECT name AS station_name, TIMESTAMP '2001-06-01' AS time, round(lat, 6) AS latitude, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS at FROM {OBSERVED} WHERE h = 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stations.ndawn_rows(_ndawn(_observed(spark, sf_dir).filter("h = 0"), None), hourly=False)
    named = stations.rename_codes(rows, {"at": "Avg Air Temp"})
    return named.select("station_name", "time", F.round("latitude", 6).alias("latitude"), "at")


@query("iem_asos", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS station, {HOUR} + INTERVAL 53 MINUTE AS valid, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS air_temp_f, 'CLR' AS sky_cover_1 FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("gone"), "M").otherwise(F.col("t").cast("string"))
    lines = _lines(_observed(spark, sf_dir), ["#DEBUG: text", "station,valid,tmpf,skyc1"], F.col("station"), F.format_string("2001-06-01 %02d:53", "h"), value, "CLR")
    return stations.iem_rows(lines).select("station", "valid", "air_temp_f", "sky_cover_1")


@query("iem_rwis", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS station, {HOUR} + INTERVAL 7 MINUTE AS valid, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS dewpoint_f, CAST(h AS DOUBLE) AS wind_speed_kt FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("gone"), "").otherwise(F.col("t").cast("string"))
    lines = _lines(_observed(spark, sf_dir), ["Station,Obtime,DWPF,SKNT"], F.col("station"), F.format_string("2001-06-01 %02d:07:30", "h"), value, F.col("h"))
    return stations.iem_rows(lines, "rwis").select("station", "valid", "dewpoint_f", "wind_speed_kt")


@query("synoptic_stations", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS stid, name, round(lat, 6) AS lat, round(lon, 6) AS lon, elevation_m AS elevation, 'N' || network AS network, CAST(network AS VARCHAR) AS mnet_id FROM stations WHERE station % 3 > 0 AND lat BETWEEN 44.55e0 AND 45.05e0 AND lon BETWEEN -95.02e0 AND -94.13e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    one = F.struct(
        text("station").alias("STID"), F.col("name").alias("NAME"), text("lat").alias("LATITUDE"), text("lon").alias("LONGITUDE"), text("elevation_m").alias("ELEVATION"),
        F.concat(F.lit("N"), text("network")).alias("MNET_SHORTNAME"), text("network").alias("MNET_ID"), F.when(F.col("station") % 3 > 0, "ACTIVE").otherwise("INACTIVE").alias("STATUS"),
    )
    texts = view(spark, sf_dir, "stations").select(F.to_json(F.struct(F.array(one).alias("STATION"))).alias("json"))
    found = stations.synoptic_stations(texts, box=BOX, active_only=True)
    return found.select("stid", "name", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "elevation", "network", "mnet_id")


def _documents(spark: SparkSession, sf_dir: str, made) -> DataFrame:
    rows = _observed(spark, sf_dir).groupBy("station").agg(F.array_sort(F.collect_list(F.struct("h", "t", "gone"))).alias("o"))
    return rows.select(F.to_json(F.struct(F.array(F.struct(F.col("station").cast("string").alias("STID"), made(F.col("o")).alias("OBSERVATIONS"))).alias("STATION"))).alias("json"))


@query("synoptic_hourly", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS stid, {HOUR} AS time, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS air_temp, CAST(h AS DOUBLE) AS wind_speed FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda o: F.struct(
        F.transform(o, lambda x: F.format_string("2001-06-01T%02d:00:00Z", x["h"])).alias("date_time"),
        F.transform(o, lambda x: F.when(~x["gone"], x["t"].cast("string"))).alias("air_temp_set_1"), F.transform(o, lambda x: x["h"].cast("string")).alias("wind_speed"),
    )
    return stations.synoptic_hourly(_documents(spark, sf_dir, made), ["air_temp", "wind_speed"])


@query("synoptic_precipitation", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS stid, {HOUR} AS time, CASE WHEN NOT gone THEN CAST(t AS DOUBLE) END AS precip_mm FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = lambda o: F.struct(F.transform(o, lambda x: F.struct(F.format_string("2001-06-01T%02d:00:00Z", x["h"]).alias("last_report"), F.when(~x["gone"], x["t"].cast("string")).alias("total"))).alias("precipitation"))
    return stations.synoptic_precipitation(_documents(spark, sf_dir, made))


@query("ndawn_stations", f"{ctes('stations')} SELECT name, CAST(station AS VARCHAR) AS internal_id, round(lat, 6) AS lat, round(lon, 6) AS lon, elevation_m AS elevation_ft, '1990 to date' AS period_of_record FROM stations WHERE station % 4 > 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map page's links, and the page of each station, some without coordinates."""
    rows = view(spark, sf_dir, "stations").filter("station % 4 > 0 OR station % 8 = 0")
    area = F.concat(F.lit('<area shape="rect" title="'), "name", F.lit('" class="s" href="/station-info.html?station='), F.col("station").cast("string"), F.lit('">'))
    links = stations.ndawn_links(rows.select(F.concat(F.lit("<map>"), area, F.lit('<area title="x" href="/none"></map>')).alias("html")))
    place = F.concat(F.lit("Latitude:</th><td> "), F.col("lat").cast("string"), F.lit("&deg;</td> Longitude:</th>\n<td>"), F.col("lon").cast("string"), F.lit("&deg;"))
    page = F.concat(F.when(F.col("station") % 4 > 0, place).otherwise(""), F.lit("Elevation: <td>"), F.col("elevation_m").cast("string"), F.lit(" feet Period of record: <td> 1990 to date </td>"))
    told = stations.ndawn_details(rows.select(F.col("station").cast("string").alias("internal_id"), page.alias("html")))
    return links.join(told, "internal_id").select("name", "internal_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "elevation_ft", "period_of_record")


@query("station_name_to_id", f"{ctes('stations')} SELECT name AS station_name, h, CASE WHEN station % 2 = 0 THEN CAST(station AS VARCHAR) END AS internal_id FROM {OBSERVED}")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = view(spark, sf_dir, "stations").filter("station % 2 = 0").select("name", F.col("station").cast("string").alias("internal_id"))
    rows = _observed(spark, sf_dir).select(F.col("name").alias("station_name"), "h")
    return stations.with_station_id(rows, known).select("station_name", "h", "internal_id")


# --- gridded sources -----------------------------------------------------------------------------------


@query("radar_rows", f"{ctes('cells')} SELECT time, round(lat, 6) AS lat, round(lon, 6) AS lon, round(rainf, 6) AS precip_mm FROM cells")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "cells").select("time", F.col("lat").alias("latitude"), (F.col("lon") + 360.0).alias("longitude"), F.col("swdown").alias("heat"), F.col("rainf").alias("paramId_0"))
    return gridded.radar(raw).select("time", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.round("precip_mm", 6).alias("precip_mm"))


@query("tidy_to_wide", f"{ctes('cells')} SELECT time, round(lat, 6) AS lat, round(lon, 6) AS lon, round(max(tair_k), 6) AS \"Tair\", round(max(rainf), 6) AS \"Rainf\" FROM cells GROUP BY 1, 2, 3")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "cells").groupBy("time", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")).agg(F.max("tair_k").alias("Tair"), F.max("rainf").alias("Rainf"))
    tidy = ti.long_concat(cells, ["time", "lat", "lon"], ["Tair", "Rainf"])
    made = gridded.wide(tidy, ["Tair", "Rainf"])
    return made.select("time", "lat", "lon", F.round("Tair", 6).alias("Tair"), F.round("Rainf", 6).alias("Rainf"))


@query("long_concat", f"{ctes('fine_gaps', 'coarse')} SELECT zone, time, 'fine_mm' AS variable, round(f.precip_mm, 6) AS value FROM fine_gaps f FULL JOIN coarse c USING (zone, time) UNION ALL SELECT zone, time, 'coarse_mm', round(c.precip_mm, 6) FROM fine_gaps f FULL JOIN coarse c USING (zone, time)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "fine_gaps").select("zone", "time", F.round("precip_mm", 6).alias("fine_mm"))
    both = ti.merge(a, view(spark, sf_dir, "coarse").select("zone", "time", F.round("precip_mm", 6).alias("coarse_mm")), ["zone", "time"])
    return ti.long_concat(both, ["zone", "time"], ["fine_mm", "coarse_mm"])


@query("missing_units", "WITH wanted AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, 'v' || (l_linenumber % 3) AS variable FROM lineitem), have AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, 'v' || (l_linenumber % 3) AS variable FROM lineitem WHERE l_partkey % 2 = 0) SELECT CAST(date AS VARCHAR) AS date, variable FROM wanted ANTI JOIN have USING (date, variable)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", F.to_date("l_shipdate").alias("date"), F.concat(F.lit("v"), (F.col("l_linenumber") % 3).cast("string")).alias("variable"))
    lacking = store.lacking(rows.select("date", "variable").distinct(), rows.filter("l_partkey % 2 = 0"))
    return lacking.select(F.col("date").cast("string").alias("date"), "variable")


# --- space ---------------------------------------------------------------------------------------------

TARGETS = "t AS (SELECT s_suppkey AS target_id, 44e0 + (s_suppkey % 37) * 0.05e0 + 0.0713e0 AS lat, -96e0 + (s_suppkey % 53) * 0.05e0 + 0.0317e0 AS lon FROM supplier)"


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(k.alias("target_id"), (44.0 + (k % 37) * 0.05 + 0.0713).alias("lat"), (-96.0 + (k % 53) * 0.05 + 0.0317).alias("lon"))


@query("regrid_bilinear", f"""{ctes('cells')}, {TARGETS}, b AS (SELECT *, (lat - 44e0) / 0.1e0 - 0.5e0 AS y, (lon + 96e0) / 0.1e0 - 0.5e0 AS x FROM t),
c AS (SELECT target_id, CAST(floor(y) AS INT) + di AS lat_idx, CAST(floor(x) AS INT) + dj AS lon_idx, (CASE WHEN di = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dj = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS weight FROM b, (VALUES (0), (1)) p(di), (VALUES (0), (1)) r(dj)),
w AS (SELECT * FROM c WHERE lat_idx BETWEEN 0 AND 19 AND lon_idx BETWEEN 0 AND 29 AND weight > 1e-12),
g AS (SELECT lat_idx, lon_idx, CAST(date_trunc('year', time) AS TIMESTAMP) AS time, avg(tair_k) AS v FROM cells WHERE (lat_idx + lon_idx) % 11 > 0 GROUP BY 1, 2, 3)
SELECT target_id, time, round(CASE WHEN abs(sum(weight) - 1) < 1e-9 THEN sum(v * weight) END, 5) AS v FROM g JOIN w USING (lat_idx, lon_idx) GROUP BY 1, 2""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "cells").filter("(lat_idx + lon_idx) % 11 > 0")
    grids = cells.groupBy("lat_idx", "lon_idx", ti.period_start(F.col("time"), "year").alias("time")).agg(F.avg("tair_k").alias("v"))
    return sp.regrid(grids, _targets(spark, sf_dir), GRID, ["v"]).select("target_id", "time", F.round("v", 5).alias("v"))


LAMBERT_N, LAMBERT_F, LAMBERT_0 = sp._lambert(50.0, 50.0, 50.0, 6_371_229.0)
LAMBERT = f"{LAMBERT_F!r}e0 / pow(tan(pi() / 4 + radians(lat) / 2), {LAMBERT_N!r}e0)"
PROJECTED = f"xy AS (SELECT *, {LAMBERT} * sin({LAMBERT_N!r}e0 * radians(lon + 107e0)) AS x, {LAMBERT_0!r}e0 - {LAMBERT} * cos({LAMBERT_N!r}e0 * radians(lon + 107e0)) AS y FROM t)"


@query("conformal_projection", f"WITH {TARGETS}, {PROJECTED} SELECT target_id, round(x, 3) AS x, round(y, 3) AS y FROM xy")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sp.on_conformal(_targets(spark, sf_dir))
    return made.select("target_id", F.round("lon", 3).alias("x"), F.round("lat", 3).alias("y"))


_xs, _ys = zip(*[sp.lambert_point(a, b) for a in (44.5, 44.75, 45.0) for b in (-95.0, -94.5, -94.0)], strict=True)


@query("conformal_clip", f"WITH {TARGETS}, {PROJECTED} SELECT target_id FROM xy WHERE x BETWEEN {min(_xs)!r}e0 AND {max(_xs)!r}e0 AND y BETWEEN {min(_ys)!r}e0 AND {max(_ys)!r}e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sp.on_conformal(_targets(spark, sf_dir)).withColumnsRenamed({"lat": "y", "lon": "x"})
    return sp.clip_conformal(placed, sp.BoundingBox(-95.0, 44.5, -94.0, 45.0)).select("target_id")


@query("weightmap_valid_cells", f"{ctes('cells', 'polygons')}, {OVERLAPS} SELECT polygon_index, lat_idx, lon_idx, round(weight, 6) AS weight FROM weights SEMI JOIN (SELECT DISTINCT lat_idx, lon_idx FROM cells WHERE l_orderkey % 7 = 0) v USING (lat_idx, lon_idx)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = view(spark, sf_dir, "cells").filter("l_orderkey % 7 = 0")
    return sp.build_weights(_overlaps(spark, sf_dir), "polygon_index", valid=valid).select("polygon_index", "lat_idx", "lon_idx", F.round("weight", 6).alias("weight"))


@query("single_polygon_mean", f"{ctes('cells', 'polygons')}, {OVERLAPS}, g AS (SELECT lat_idx, lon_idx, time, avg(tair_k) AS v FROM cells GROUP BY 1, 2, 3) SELECT time, round(sum(v * weight), 4) AS v FROM g JOIN weights USING (lat_idx, lon_idx) WHERE polygon_index = 3 GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids = view(spark, sf_dir, "cells").groupBy("lat_idx", "lon_idx", "time").agg(F.avg("tair_k").alias("v"))
    weights = sp.polygon_weights(view(spark, sf_dir, "polygons"), GRID, "polygon_index", 3)
    return sp.zonal_sum(grids, weights, "polygon_index", ["v"]).select("time", F.round("v", 4).alias("v"))


# --- disaggregation ------------------------------------------------------------------------------------


@query("disagg_inferred_offset", f"{WEIGHTED} SELECT zone, time, round(CASE WHEN c IS NOT NULL THEN greatest(c * CASE WHEN s > 0 THEN precip_mm / nullif(s, 0) ELSE 1e0 / n END, 0e0) END, 6) AS precip_mm FROM j")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = fine(spark, sf_dir).withColumnRenamed("precip_mm", "pattern")
    made = dis.disaggregate(view(spark, sf_dir, "coarse"), "sum", ["zone"], "precip_mm", pattern, "pattern")
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


@query("disagg_monthly", f"""{ctes('fine')}, m AS (SELECT zone, CAST(date_trunc('month', time) AS TIMESTAMP) AS p, sum(precip_mm) / 2e0 AS c FROM fine GROUP BY 1, 2), w AS (SELECT zone, time, CAST(date_trunc('month', time) AS TIMESTAMP) AS p, precip_mm, sum(precip_mm) OVER (PARTITION BY zone, date_trunc('month', time)) AS s FROM fine)
SELECT zone, time, round(c * precip_mm / nullif(s, 0), 6) AS precip_mm FROM w JOIN m USING (zone, p)""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = fine(spark, sf_dir)
    monthly = ti.resample(hourly, ["zone"], [(F.sum("precip_mm") / 2).alias("precip_mm")], "month")
    made = dis.disaggregate(monthly, "sum", ["zone"], "precip_mm", hourly.withColumnRenamed("precip_mm", "pattern"), "pattern", offset_hours=0, unit="month")
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


@query("disagg_monthly_static", f"{ctes('fine')}, m AS (SELECT zone, CAST(date_trunc('month', time) AS TIMESTAMP) AS p, sum(precip_mm) AS c FROM fine GROUP BY 1, 2) SELECT zone, unnest(generate_series(p, p + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time, round(c / (date_diff('hour', p, p + INTERVAL 1 MONTH)), 6) AS precip_mm FROM m")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = ti.resample(fine(spark, sf_dir), ["zone"], [F.sum("precip_mm").alias("precip_mm")], "month")
    made = dis.disaggregate(monthly, "sum", ["zone"], "precip_mm", weight_method="static", unit="month")
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


@query("cloud_factor_hourly", f"{ctes('cells')}, h AS (SELECT lat_idx, time, avg(swdown) AS rs, avg({GEOMETRIC}) AS rso FROM cells GROUP BY 1, 2), d AS (SELECT *, sum(rs) OVER (PARTITION BY lat_idx, {DAY}) AS a, sum(rso) OVER (PARTITION BY lat_idx, {DAY}) AS b FROM h) SELECT lat_idx, time, round(1.35e0 * least(greatest(CASE WHEN b > 0 THEN a / nullif(b, 0) ELSE 1e0 END, 0.25e0), 1e0) - 0.35e0, 6) AS factor FROM d")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    clear = rad.clearsky_geometric(F.col("time"), "lat")
    hourly = view(spark, sf_dir, "cells").groupBy("lat_idx", "time").agg(F.avg("swdown").alias("rs"), F.avg(clear).alias("rso"))
    return dis.cloud_factor_hourly(hourly, ["lat_idx"], "rs", "rso").select("lat_idx", "time", F.round("cloud_factor", 6).alias("factor"))


# --- legacy variants -----------------------------------------------------------------------------------

FRACTIONS = f"{OVERLAPS}, fractions AS (SELECT polygon_index, lat_idx, lon_idx, area / sum(area) OVER (PARTITION BY polygon_index) AS fraction FROM over)"


@query("region_fractions", f"{ctes('polygons')}, {FRACTIONS} SELECT polygon_index, lat_idx, lon_idx, round(fraction, 6) AS fraction FROM fractions")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.region_fractions(_overlaps(spark, sf_dir), "polygon_index").select("polygon_index", "lat_idx", "lon_idx", F.round("fraction", 6).alias("fraction"))


def pan(low: str, high: str, dew: str, wind: str, sun: str) -> str:
    t, s = f"(({low} + {high}) / 2)", f"(CASE WHEN {sun} <= 0 THEN 0.00001e0 ELSE {sun} END)"
    moved = f"0.0105e0 * pow(greatest({lamoreux(t)} - {lamoreux(dew)}, 0e0), 0.88e0) * (0.37e0 + 0.0041e0 * {wind})"
    return f"greatest((exp(({t} - 212) * (0.1024e0 - 0.01066e0 * ln({s}))) - 0.0001e0 + {moved}) / (47987800000e0 * exp(-7482.6e0 / ({t} + 398.36e0)) / (({t} + 398.36e0) * ({t} + 398.36e0)) + 0.0105e0), 0e0)"


@query("legacy_pan", f"{ctes('daily_met')} SELECT l_orderkey, l_linenumber, round({pan('(temp_min_c * 9 / 5 + 32)', '(temp_max_c * 9 / 5 + 32)', '(temp_dew_c * 9 / 5 + 32)', '(wind_ms * 53.6819e0)', '((solar_mj - 5) * 23.8845e0)')}, 6) AS pan FROM daily_met")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = lambda c: F.col(c) * 9 / 5 + 32
    made = legacy.penman_pan(f("temp_min_c"), f("temp_max_c"), f("temp_dew_c"), F.col("wind_ms") * 53.6819, (F.col("solar_mj") - 5) * 23.8845)
    return view(spark, sf_dir, "daily_met").select("l_orderkey", "l_linenumber", F.round(made, 6).alias("pan"))


KPA_CC = "((qair / (1e0 - qair)) / (0.622e0 + qair / (1e0 - qair)) * psurf_pa / 1e3)"
LEGACY = f"""{ctes('cells', 'polygons')}, {FRACTIONS},
raw AS (SELECT polygon_index, time, sum(tair_k * fraction) AS tair_k, sum(qair * fraction) AS qair, sum(psurf_pa * fraction) AS psurf_pa, sum(wind_e * fraction) AS wind_e, sum(wind_n * fraction) AS wind_n, sum(swdown * fraction) AS swdown FROM cells JOIN fractions USING (lat_idx, lon_idx) GROUP BY 1, 2),
hourly AS (SELECT polygon_index, time - INTERVAL 6 HOUR AS time, (tair_k - 273.15e0) * 9 / 5 + 32 AS t, (1e0 / (1e0 / 273.15e0 - 0.0001844e0 * ln({KPA_CC} / 0.6113e0)) - 273.15e0) * 9 / 5 + 32 AS d, sqrt(wind_e * wind_e + wind_n * wind_n) * pow(0.2e0, 0.143e0) * 2.23694e0 AS w, swdown / 11.63e0 AS s FROM raw),
daily AS (SELECT polygon_index, {DAY} AS time, min(t) AS lo, max(t) AS hi, avg(d) AS d, sum(w) AS w, sum(s) AS s FROM hourly GROUP BY 1, 2),
pans AS (SELECT polygon_index, time, {pan('lo', 'hi', 'd', 'w', 's')} AS pan_in FROM daily)"""


@query("legacy_zone_pan", f"{LEGACY} SELECT polygon_index, time, round(pan_in, 6) AS pan_in FROM pans")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _legacy_pan(spark, sf_dir).select("polygon_index", "time", F.round("pan_in", 6).alias("pan_in"))


def _legacy_pan(spark: SparkSession, sf_dir: str) -> DataFrame:
    fractions = sp.region_fractions(_overlaps(spark, sf_dir), "polygon_index")
    return legacy.zone_evaporation(legacy.zone_hours(view(spark, sf_dir, "cells"), fractions, "polygon_index"), "polygon_index")


SHARE_D = "(7.6394e0 * acos(least(greatest(-tan(radians(lat)) * tan(0.40928e0 * cos(0.0172141e0 * (172e0 - (30.5e0 * (month(time) - 1) + day(time))))), -1e0), 1e0)))"


@query("legacy_hourly_pan", f"""{LEGACY}, z AS (SELECT polygon_index, (south + north) / 2 AS lat FROM polygons), u AS (SELECT p.polygon_index, lat, p.time + INTERVAL 1 HOUR * h AS time, h, pan_in FROM pans p JOIN z USING (polygon_index), range(24) r(h)),
g AS (SELECT *, abs(h - 12e0) AS noon, {SHARE_D} / 2 AS half FROM u)
SELECT polygon_index, time, round(pan_in * CASE WHEN half > 0 THEN 0.66666667e0 / half * least(greatest((half - noon) / (half / 2), 0e0), 1e0) ELSE 0e0 END, 6) AS pan_in FROM g""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lats = view(spark, sf_dir, "polygons").select("polygon_index", ((F.col("south") + F.col("north")) / 2).alias("lat"))
    made = legacy.spread_evaporation(_legacy_pan(spark, sf_dir), lats, "polygon_index")
    return made.select("polygon_index", "time", F.round("pan_in", 6).alias("pan_in"))


ENDED = HYBRID.replace("FROM fine)", "FROM moved)").replace(", f AS (", ", moved AS (SELECT zone, time - INTERVAL 1 HOUR AS time, precip_mm FROM fine), ends AS (SELECT zone, time - INTERVAL 24 HOUR AS time, precip_mm FROM coarse), f AS (", 1).replace("JOIN coarse c", "JOIN ends c")


@query("legacy_hybrid", f"{ENDED.replace('CASE WHEN dayofyear(time - INTERVAL 12 HOUR) % 3 = 0 THEN 0e0 ELSE precip_mm END', 'CASE WHEN dayofyear(time - INTERVAL 11 HOUR) % 3 = 0 THEN 0e0 ELSE precip_mm END').replace('dayofyear(c.time) % 7', 'dayofyear(c.time + INTERVAL 24 HOUR) % 7')}, {cascade_sql('src')} SELECT j.zone, j.time + INTERVAL 1 HOUR AS time, round(CASE WHEN c > 0 AND s > 0 THEN c * (v / nullif(s, 0)) WHEN c > 0 THEN coalesce(d.value, 0e0) ELSE 0e0 END, 6) AS precip_mm FROM j LEFT JOIN drawn d ON d.zone = j.zone AND d.time = j.time AND d.period = j.p")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = legacy.hybrid_end_labelled(*_hybrid_inputs(spark, sf_dir), "zone", "precip_mm", _parameters(spark), offset_hours=12)
    return made.select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


@query("legacy_cloud", f"{ctes('cells')}, t AS (SELECT lat_idx, CAST(date_trunc('day', time) AS TIMESTAMP) + INTERVAL 3 HOUR * CAST(floor(hour(time) / 3e0) AS INT) AS time, avg(qair) * 5e3 AS percent FROM cells GROUP BY 1, 2) SELECT lat_idx, time - INTERVAL 6 HOUR + INTERVAL 1 HOUR * h AS time, round(percent / 10e0, 6) AS tenths FROM t, range(3) r(h)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = ti.period_start(F.col("time")) + ti.hours((F.floor(F.hour("time") / 3) * 3).cast("int"))
    cells = view(spark, sf_dir, "cells").groupBy("lat_idx", slot.alias("time")).agg((F.avg("qair") * 5000.0).alias("tenths"))
    return legacy.percent_to_tenths(cells, "tenths", ["lat_idx"], 3, 6).select("lat_idx", "time", F.round("tenths", 6).alias("tenths"))


@query("run_problems", f"{ctes('polygons')} SELECT CAST(polygon_index AS VARCHAR) AS zone, 'outside the extent' AS problem FROM polygons WHERE NOT (west >= -95.5e0 AND south >= 44.2e0 AND east <= -93.5e0 AND north <= 45.8e0) UNION ALL SELECT 'all', 'fewer than 32 days'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.run_problems(view(spark, sf_dir, "polygons"), "polygon_index", sp.BoundingBox(-95.5, 44.2, -93.5, 45.8), date(2001, 1, 1), date(2001, 1, 20))


@query("days", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series(TIMESTAMP '1994-12-31', TIMESTAMP '1996-02-29', INTERVAL 1 DAY)) AS d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of every day of a range, days without any as well; its end is not in it."""
    placed = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("date"), "o_orderkey")
    counted = ti.days(spark, "1994-12-31", "1996-03-01").join(placed, "date", "left").groupBy("date").agg(F.count("o_orderkey").alias("orders"))
    return counted.select(F.col("date").cast("string").alias("date"), "orders")


# --- data sets by number, first rows, unions ------------------------------------------------------------


@query("dsn_series", f"{ctes('fine_gaps', 'coarse')}, z AS (SELECT zone, time, f.precip_mm AS a, c.precip_mm AS b FROM fine_gaps f FULL JOIN coarse c USING (zone, time)) SELECT CAST('10' || zone AS INT) AS dsn, time, round(a, 6) AS value FROM z WHERE a IS NOT NULL UNION ALL SELECT CAST('13' || zone AS INT), time, round(b, 6) FROM z WHERE b IS NOT NULL")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dsn_rows(spark, sf_dir).select("dsn", "time", F.round("value", 6).alias("value"))


def _dsn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (view(spark, sf_dir, t).withColumnRenamed("precip_mm", c) for t, c in (("fine_gaps", "a"), ("coarse", "b")))
    return store.dsn_rows(ti.merge(a, b, ["zone", "time"]), "zone", {"PREC": "a", "PEVT": "b"})


@query("dsn_summary", f"{ctes('fine_gaps', 'coarse')}, z AS (SELECT zone, time, 10 AS kind FROM fine_gaps UNION ALL SELECT zone, time, 13 FROM coarse) SELECT CAST(kind || '' || zone AS INT) AS dsn, min(time) AS first, max(time) AS last, count(*) AS n, CAST(kind AS INT) AS kind, zone FROM z GROUP BY zone, kind")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.dsn_summary(_dsn_rows(spark, sf_dir))


@query("first_rows", f"{ctes('fine_gaps')} SELECT zone, min(time) AS time, round(arg_min(precip_mm, time), 6) AS precip_mm FROM fine_gaps GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.first_rows(view(spark, sf_dir, "fine_gaps"), ["zone"], ["precip_mm"]).select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))
