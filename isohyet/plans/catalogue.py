"""Every query of the library, each with an independent statement in DuckDB SQL where one exists."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions import evaporation as ev
from isohyet.functions import radiation as rad
from isohyet.functions import thermo as th
from isohyet.functions.cols import hash_uniform
from isohyet.operators import cascade as cas
from isohyet.operators import disaggregate as dis
from isohyet.operators import spatial as sp
from isohyet.operators import store
from isohyet.operators import time as ti
from isohyet.plans import recipes
from isohyet.plans.registry import ORACLE, QUERIES, Query, query
from isohyet.plans.views import GRID, RAIN_GRID, ctes, fine, view
from isohyet.sources import canonical, stations

# --- formulas by row -------------------------------------------------------------------------

TC = "(tair_k - 273.15e0)"
KPA = "(psurf_pa / 1e3)"
SPEED = "sqrt(wind_e * wind_e + wind_n * wind_n)"
MIX = "((qair / (1e0 - qair)) / (0.622e0 + qair / (1e0 - qair)) * psurf_pa / 1e3)"
LN_MIX = f"ln({MIX} / 0.6112e0)"
DEW = f"(237.7e0 * {LN_MIX} / (17.27e0 - {LN_MIX}))"
SBT4 = f"(5.67e-8 * pow({TC} + 273.15e0, 4))"


def svp(t: str, b: str = "237.3e0", base: str = "0.6108e0") -> str:
    return f"({base} * exp(17.27e0 * {t} / ({t} + {b})))"


def clipped(x: str, low: str | None = None, high: str | None = None) -> str:
    inner = f"greatest({x}, {low})" if low else f"({x})"
    return f"(CASE WHEN ({x}) IS NOT NULL THEN {f'least({inner}, {high})' if high else inner} END)"


DOY = "CAST(dayofyear(time) AS DOUBLE)"
GEO_DECL = f"radians(23.45e0 * sin(radians(360e0 / 365 * (284 + {DOY}))))"
GEOMETRIC = f"(1361e0 * greatest(sin(radians(lat)) * sin({GEO_DECL}) + cos(radians(lat)) * cos({GEO_DECL}) * cos(radians(15e0 * (hour(time) - 12))), 0e0) * 0.75e0)"


def extra(day: str) -> str:
    theta = f"(2 * pi() / 365 * CAST(dayofyear({day}) AS DOUBLE))"
    decl = f"(0.409e0 * sin({theta} - 1.39e0))"
    sunset = f"acos(least(greatest(-tan(radians(lat)) * tan({decl}), -1e0), 1e0))"
    return f"(118.08e0 / pi() * (1 + 0.033e0 * cos({theta})) * ({sunset} * sin(radians(lat)) * sin({decl}) + cos(radians(lat)) * cos({decl}) * sin({sunset})))"


def hww(day: str) -> str:
    g = f"(2 * pi() * CAST(dayofyear({day}) - 1 AS DOUBLE) / 365)"
    decl = f"(0.006918e0 - 0.399912e0 * cos({g}) + 0.070257e0 * sin({g}) - 0.006758e0 * cos(2 * {g}) + 0.000907e0 * sin(2 * {g}) - 0.002697e0 * cos(3 * {g}) + 0.00148e0 * sin(3 * {g}))"
    dr = f"(1.00011e0 + 0.034221e0 * cos({g}) + 0.00128e0 * sin({g}) + 0.000719e0 * cos(2 * {g}) + 0.000077e0 * sin(2 * {g}))"
    sunset = f"acos(least(greatest(-tan(radians(lat)) * tan({decl}), -1e0), 1e0))"
    return f"(0.73e0 * (117.5e0 / pi() * {dr} * ({sunset} * sin(radians(lat)) * sin({decl}) + cos(radians(lat)) * cos({decl}) * sin({sunset}))))"


HOUR = "(hour(time) + minute(time) / 60e0 + second(time) / 3600e0)"
SUN_DAYS = f"(date_diff('day', DATE '1970-01-01', CAST(time AS DATE)) + {HOUR} / 24e0 - 10957.5e0)"
SUN_G = f"radians(357.528e0 + 0.9856003e0 * {SUN_DAYS})"
SUN_L = f"radians(280.460e0 + 0.9856474e0 * {SUN_DAYS} + 1.915e0 * sin({SUN_G}) + 0.020e0 * sin(2 * {SUN_G}))"
SUN_TILT = f"radians(23.439e0 - 0.0000004e0 * {SUN_DAYS})"
SUN_TURN = f"radians(280.46061837e0 + 15e0 * {HOUR} - 180e0 + 0.98564736629e0 * {SUN_DAYS} + lon)"
SUN_TRUE = f"""degrees(asin(least(greatest(sin(radians(lat)) * sin({SUN_TILT}) * sin({SUN_L})
  + cos(radians(lat)) * (cos({SUN_TURN}) * cos({SUN_L}) + sin({SUN_TURN}) * cos({SUN_TILT}) * sin({SUN_L})), -1e0), 1e0)))"""
SUN = f"(SELECT t + CASE WHEN t > -1e0 THEN 1.02e0 / tan(radians(t + 10.3e0 / (t + 5.11e0))) / 60e0 ELSE 0e0 END FROM (SELECT {SUN_TRUE} AS t))"


def ineichen(sun: str, turbidity: str = "3e0", altitude: str = "0e0") -> str:
    up = f"greatest(sin(radians({sun})), 0e0)"
    mass = f"(1e0 / ({up} + 0.50572e0 * pow(greatest({sun}, 0e0) + 6.07995e0, -1.6364e0)))"
    loss = f"((3.92e-5 * {altitude} + 0.0387e0) * {mass} * (exp(-({altitude}) / 8000) + exp(-({altitude}) / 1250) * ({turbidity} - 1)))"
    outside = "(1367e0 * (1 + 0.033e0 * cos(2 * pi() / 365 * CAST(dayofyear(time) AS DOUBLE))))"
    return f"(CASE WHEN {sun} > 0 THEN (5.09e-5 * {altitude} + 0.868e0) * {outside} * {up} * exp(-{loss}) * exp(0.01e0 * pow({mass}, 1.8e0)) WHEN {sun} IS NOT NULL THEN 0e0 END)"


def lamoreux(f: str) -> str:
    return f"(6413252e0 * exp(-7482.6e0 / ({f} + 398.36e0)))"


TF, DF = "(temp_mean_c * 9 / 5 + 32)", "(temp_dew_c * 9 / 5 + 32)"
SOLAR_LY = "greatest(solar_mj * 23.8845e0, 25e0)"
KNB = (
    f"greatest(((exp(({TF} - 212) * (0.1024e0 - 0.01066e0 * ln({SOLAR_LY}))) - 0.0001e0) + 0.0105e0 * pow(greatest({lamoreux(TF)} - {lamoreux(DF)}, 0e0), 0.88e0) * (0.37e0 + 0.0041e0 * (wind_ms * 53.6819e0)))"
    f" / (4.79878e10 * exp(-7482.6e0 / ({TF} + 398.36e0)) / (({TF} + 398.36e0) * ({TF} + 398.36e0)) + 0.0105e0) * 25.4e0, 0e0)"
)
RN = f"(swdown * (1 - 0.23e0) + lwdown - 0.97e0 * {SBT4})"
RN_MJ = f"({RN} * 0.0036e0)"
DELTA = f"(17.27e0 * 237.3e0 * {svp(TC)} / (({TC} + 237.3e0) * ({TC} + 237.3e0)))"
GAMMA = f"(0.000665e0 * {KPA})"
PM = (
    f"greatest((0.408e0 * {DELTA} * ({RN_MJ} - CASE WHEN {RN_MJ} > 0 THEN 0.1e0 ELSE 0.5e0 END * {RN_MJ}) + {GAMMA} * 37e0 / ({TC} + 273.15e0) * {SPEED} * greatest({svp(TC)} - {svp(DEW)}, 0e0))"
    f" / ({DELTA} + {GAMMA} * (1 + CASE WHEN {RN_MJ} > 0 THEN 0.24e0 ELSE 0.96e0 END * {SPEED})), 0e0)"
)
SH = f"(0.622e0 * {svp(DEW)} / ({KPA} - 0.378e0 * {svp(DEW)}))"


def rh(q: str) -> str:
    return f"least(greatest(100 * ({q} * {KPA} / (0.622e0 + {q}) / {svp(TC)}), 0e0), 100e0)"


tc = lambda: th.kelvin_to_celsius("tair_k")
speed = lambda: th.wind_speed("wind_e", "wind_n")
mix = lambda: th.vapor_pressure_mixing("qair", "psurf_pa")
dew = lambda: th.dewpoint_august_roche_magnus("qair", "psurf_pa")
clear = lambda: rad.clearsky_geometric(F.col("time"), "lat")
sun = lambda: rad.solar_elevation(F.col("time"), "lat", "lon")

ROWS: dict[str, tuple[str, Callable[[], dict[str, Column]], dict[str, str]]] = {
    "temp_convert": ("cells", lambda: {"c": tc(), "f": th.kelvin_to_fahrenheit("tair_k")}, {"c": TC, "f": f"{TC} * 9 / 5 + 32"}),
    "wind_speed_adjust": ("cells", lambda: {"speed": speed(), "log_2m": th.adjust_wind_height(speed()), "power_2m": th.adjust_wind_height(speed(), method="power_law")}, {"speed": SPEED, "log_2m": f"{SPEED} * (ln(67.8e0 * 2 - 5.42e0) / ln(67.8e0 * 10 - 5.42e0))", "power_2m": f"{SPEED} * pow(0.2e0, 1e0 / 7)"}),
    "wind_functions": ("cells", lambda: {"kohler": th.wind_function_kohler(speed()), "fao56": th.wind_function_fao56(speed(), tc())}, {"kohler": f"0.005e0 + 0.00085e0 * 3.6e0 * {SPEED}", "fao56": f"37e0 / ({TC} + 273) * {SPEED}"}),
    "latent_heat_psychro": ("cells", lambda: {"latent": th.latent_heat_linear(tc()), "gamma": th.psychrometric_constant_dynamic(F.col("psurf_pa") / 1000, th.latent_heat_linear(tc()))}, {"latent": f"2.501e0 - 0.002361e0 * {TC}", "gamma": f"0.00163e0 * {KPA} / (2.501e0 - 0.002361e0 * {TC})"}),
    "vapor_pressures": ("cells", lambda: {"magnus": th.vapor_pressure_magnus(tc()), "lamoreux": th.vapor_pressure_lamoreux(th.kelvin_to_fahrenheit("tair_k")), "mixing": mix()}, {"magnus": svp(TC), "lamoreux": lamoreux(f"({TC} * 9 / 5 + 32)"), "mixing": MIX}),
    "delta_svp": ("cells", lambda: {"delta": th.delta_svp(tc())}, {"delta": DELTA}),
    "dewpoint_magnus": ("cells", lambda: {"dew": th.dewpoint_magnus(mix())}, {"dew": DEW}),
    "dewpoint_cc": ("cells", lambda: {"dew": th.dewpoint_from_specific_humidity_cc("qair", "psurf_pa")}, {"dew": f"1e0 / (1e0 / 273.15e0 - 0.0001844e0 * ln({MIX} / 0.6113e0)) - 273.15e0"}),
    "dewpoint_arm": ("cells", lambda: {"dew": dew()}, {"dew": DEW}),
    "dewpoint_bolton": ("cells", lambda: {"dew": th.dewpoint_from_specific_humidity("qair", "psurf_pa")}, {"dew": f"243.5e0 * ln({MIX} * 10 / 6.112e0) / (17.67e0 - ln({MIX} * 10 / 6.112e0))"}),
    "specific_humidity": ("cells", lambda: {"q": th.specific_humidity(dew(), "psurf_pa")}, {"q": SH}),
    "relative_humidity": ("cells", lambda: {"from_q": th.relative_humidity_from_specific_humidity(tc(), "qair", "psurf_pa"), "from_dew": th.relative_humidity(tc(), dew(), "psurf_pa")}, {"from_q": rh("qair"), "from_dew": rh(SH)}),
    "net_radiation": ("cells", lambda: {"net": rad.net_radiation("swdown", "lwdown", tc()), "arm": rad.net_radiation_arm("swdown", tc(), dew())}, {"net": RN, "arm": f"swdown * (1 - 0.23e0) - {SBT4} * (0.34e0 - 0.14e0 * sqrt({svp(DEW, '237.7e0', '0.6112e0')}))"}),
    "net_longwave_direct": ("cells", lambda: {"net": rad.net_longwave_direct(tc(), "lwdown")}, {"net": f"0.98e0 * {SBT4} - lwdown"}),
    "net_longwave_brutsaert": ("cells", lambda: {"net": rad.net_longwave_brutsaert(tc(), mix())}, {"net": f"0.98e0 * {SBT4} - 1.24e0 * pow(10 * greatest({MIX}, 0e0) / ({TC} + 273.15e0), 1e0 / 7) * {SBT4}"}),
    "net_longwave_brunt": ("cells", lambda: {"net": rad.net_longwave_brunt(tc(), mix())}, {"net": f"{SBT4} * (0.34e0 - 0.14e0 * sqrt({MIX}))"}),
    "clearsky_geometric": ("cells", lambda: {"clear": clear()}, {"clear": GEOMETRIC}),
    "clearsky_hww": ("daily_met", lambda: {"clear": rad.clearsky_hww(F.col("date"), "lat")}, {"clear": hww("date")}),
    "clearsky_fao56": ("daily_met", lambda: {"clear": rad.clearsky_fao56(rad.extra_radiation(F.col("date"), "lat"), "elevation_m")}, {"clear": f"(0.75e0 + 2e-5 * elevation_m) * {extra('date')}"}),
    "extra_radiation": ("daily_met", lambda: {"ra": rad.extra_radiation(F.col("date"), "lat")}, {"ra": extra("date")}),
    "solar_elevation": ("cells", lambda: {"elevation": sun()}, {"elevation": SUN}),
    "cloud_factor_fao56": ("cells", lambda: {"factor": rad.cloud_factor_fao56("swdown", clear())}, {"factor": f"1.35e0 * least(greatest(CASE WHEN {GEOMETRIC} > 0 THEN swdown / nullif({GEOMETRIC}, 0) ELSE 1e0 END, 0.25e0), 1e0) - 0.35e0"}),
    "cloud_cover_davis": ("sky", lambda: {"cover": rad.cloud_cover_davis("swdown", "clear", "sun")}, {"cover": f"CASE WHEN {SUN} >= 10 THEN {clipped(f'sqrt((1 - {clipped(f"swdown / nullif({GEOMETRIC}, 0)", "0e0", "1e0")}) / 0.65e0)', '0e0', '1e0')} END"}),
    "cloud_cover_thompson": ("sky", lambda: {"cover": rad.cloud_cover_thompson("swdown", "clear", "sun")}, {"cover": f"CASE WHEN {SUN} >= 10 THEN {clipped(f'swdown / nullif({GEOMETRIC}, 0)', '0e0', '1e0')} END"}),
    "cloud_cover_linear": ("sky", lambda: {"cover": rad.cloud_cover_linear("swdown", "clear", "sun")}, {"cover": f"CASE WHEN {SUN} >= 10 THEN {clipped(f'1 - swdown / nullif({GEOMETRIC}, 0)', '0e0', '1e0')} END"}),
    "sky_cover_thompson": ("cells", lambda: {"sky": rad.sky_cover_thompson(clear(), F.col("qair") * 50)}, {"sky": f"{GEOMETRIC} * (0.3e0 + (1 - 0.3e0) * pow(1 - least(greatest(qair * 50, 0e0), 1e0), 0.61e0))"}),
    "actual_radiation_hww": ("daily_met", lambda: {"actual": rad.actual_radiation_hww(rad.clearsky_hww(F.col("date"), "lat"), F.col("wind_ms") * 30)}, {"actual": f"{hww('date')} * (0.22e0 + 0.78e0 * least(greatest(wind_ms * 30, 0e0), 100e0) / 100)"}),
    "pet_knb": ("daily_met", lambda: {"pet": ev.penman_knb("temp_mean_c", "temp_dew_c", "wind_ms", "solar_mj")}, {"pet": KNB}),
    "pet_oudin": ("daily_met", lambda: {"pet": ev.oudin(F.col("date"), "temp_mean_c", "lat")}, {"pet": f"greatest({extra('date')} / 2.45e0 / 100 * (temp_mean_c + 5), 0e0)"}),
    "pet_hargreaves": ("daily_met", lambda: {"pet": ev.hargreaves(F.col("date"), "temp_min_c", "temp_max_c", "lat")}, {"pet": f"greatest(0.0023e0 * ({extra('date')} / 2.45e0) * ((temp_min_c + temp_max_c) / 2 + 17.8e0) * sqrt(greatest(temp_max_c - temp_min_c, 0e0)), 0e0)"}),
    "pet_penman_monteith": ("cells", lambda: {"pet": ev.penman_monteith_asce("swdown", "lwdown", tc(), dew(), speed(), "psurf_pa")}, {"pet": PM}),
    "hspf_units": ("cells", lambda: recipes.hspf_units(tc(), dew(), speed(), "swdown", F.col("qair") * 50, "rainf", "rainf"), {"temperature_f": f"{TC} * 9 / 5 + 32", "dewpoint_f": f"{DEW} * 9 / 5 + 32", "wind_speed_mph": f"{SPEED} * 2.23694e0", "shortwave_langley": "swdown / 11.63e0", "shortwave_mj_day": "swdown * 0.0864e0", "cloud_cover_tenths": "qair * 50 * 10", "pet_in": "rainf / 25.4e0", "precip_in": "rainf / 25.4e0"}),
    "lon_wrap": ("cells", lambda: {"lon180": sp.wrap_longitude(F.col("lon") + 360.0), "again": sp.wrap_longitude(F.col("lon"))}, {"lon180": "lon", "again": "lon"}),
}


def _rows(source: str, made: Callable[[], dict[str, Column]]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = view(spark, sf_dir, "cells" if source == "sky" else source)
        rows = rows.withColumns({"sun": sun(), "clear": clear()}) if source == "sky" else rows
        return rows.select("l_orderkey", "l_linenumber", *[F.round(v, 6).alias(k) for k, v in made().items()])

    return run


for _name, (_source, _made, _sql) in ROWS.items():
    QUERIES[_name] = _rows(_source, _made)
    _table = "cells" if _source == "sky" else _source
    ORACLE[_name] = f"{ctes(_table)} SELECT l_orderkey, l_linenumber, {', '.join(f'round({v}, 6) AS {k}' for k, v in _sql.items())} FROM {_table}"


@query("clearsky_ineichen", f"{ctes('cells')}, e AS (SELECT *, {SUN} AS sun, 2e0 + qair * 1e1 AS haze, lat * 1e1 AS high FROM cells) SELECT l_orderkey, l_linenumber, round({ineichen('sun')}, 6) AS clear, round({ineichen('sun', 'haze', 'high')}, 6) AS hazy FROM e")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = view(spark, sf_dir, "cells").withColumn("sun", sun())
    hazy = rad.clearsky_ineichen("sun", F.col("time"), 2.0 + F.col("qair") * 10.0, F.col("lat") * 10.0)
    return up.select("l_orderkey", "l_linenumber", F.round(rad.clearsky_ineichen("sun", F.col("time")), 6).alias("clear"), F.round(hazy, 6).alias("hazy"))


@query("extra_radiation_hourly", f"{ctes('cells')}, e AS (SELECT *, {SUN} AS sun, 2 * pi() / 365 * CAST(dayofyear(time) - 1 AS DOUBLE) AS g FROM cells), r AS (SELECT lat_idx, lon_idx, time, 1366.1e0 * (1.00011e0 + 0.034221e0 * cos(g) + 0.00128e0 * sin(g) + 0.000719e0 * cos(2 * g) + 0.000077e0 * sin(2 * g)) * greatest(sin(radians(sun)), 0e0) AS w FROM e) SELECT lat_idx, lon_idx, CAST(date_trunc('day', time) AS TIMESTAMP) AS time, round(sum(w * 0.0036e0), 6) AS extra_mj FROM r GROUP BY 1, 2, 3")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    up = view(spark, sf_dir, "cells").withColumn("sun", sun()).withColumn("w", rad.extra_radiation_hourly(F.col("time"), "sun"))
    return ti.resample(up, ["lat_idx", "lon_idx"], [F.round(F.sum(F.col("w") * 0.0036), 6).alias("extra_mj")])


@query("daytime_mask", f"{ctes('cells')} SELECT l_orderkey, l_linenumber, {SUN} >= 10 AS daytime FROM cells")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cells").select("l_orderkey", "l_linenumber", rad.is_daytime(sun()).alias("daytime"))


# --- filters and grids -------------------------------------------------------------------------

BOX = sp.BoundingBox(-95.02, 44.55, -94.13, 45.05)


@query("clip_bbox", f"{ctes('cells')} SELECT l_orderkey, l_linenumber, lat_idx, lon_idx FROM cells WHERE lat BETWEEN 44.55e0 - 0.05e0 AND 45.05e0 + 0.05e0 AND lon BETWEEN -95.02e0 - 0.05e0 AND -94.13e0 + 0.05e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.clip_grid(view(spark, sf_dir, "cells"), BOX, GRID.dlat, GRID.dlon).select("l_orderkey", "l_linenumber", "lat_idx", "lon_idx")


@query("clip_bbox_unpadded", f"{ctes('cells')} SELECT l_orderkey, l_linenumber FROM cells WHERE lat BETWEEN 44.55e0 AND 45.05e0 AND lon BETWEEN -95.02e0 AND -94.13e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "cells").filter(BOX.holds(F.col("lat"), F.col("lon"))).select("l_orderkey", "l_linenumber")


@query("bbox_contains", f"{ctes('polygons')} SELECT polygon_index, west >= -95.5e0 AND south >= 44.2e0 AND east <= -93.5e0 AND north <= 45.8e0 AS inside FROM polygons")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "polygons").select("polygon_index", sp.contained(sp.BoundingBox(-95.5, 44.2, -93.5, 45.8)).alias("inside"))


def _grid(name: str, box: sp.BoundingBox, step: float) -> None:
    """The cells that tile a box, with the number of positions that fall into each."""
    rows, columns = round((box.north - box.south) / step), round((box.east - box.west) / step)
    row, column = f"CAST(floor((lat - {box.south!r}e0) / {step!r}e0) AS INT)", f"CAST(floor((lon - {box.west!r}e0) / {step!r}e0) AS INT)"
    tiles = f"SELECT CAST(i AS INT) AS row_id, CAST(j AS INT) AS column_id, round({box.south!r}e0 + (i + 0.5e0) * {step!r}e0, 6) AS lat, round({box.west!r}e0 + (j + 0.5e0) * {step!r}e0, 6) AS lon FROM range({rows}) a(i), range({columns}) b(j)"

    @query(name, f"{ctes('cells')}, g AS ({tiles}), h AS (SELECT {row} AS row_id, {column} AS column_id, count(*) AS n FROM cells GROUP BY 1, 2) SELECT row_id, column_id, lat, lon, coalesce(n, 0) AS n FROM g LEFT JOIN h USING (row_id, column_id)")
    def _(spark: SparkSession, sf_dir: str) -> DataFrame:
        tiles = sp.generate_grid(spark, box, step).select("row_id", "column_id", "lat", "lon")
        at = lambda c, start: F.floor((F.col(c) - start) / step).cast("int")
        hits = view(spark, sf_dir, "cells").groupBy(at("lat", box.south).alias("row_id"), at("lon", box.west).alias("column_id")).agg(F.count(F.lit(1)).alias("n"))
        return tiles.join(hits, ["row_id", "column_id"], "left").na.fill({"n": 0})


_grid("grid_cells_nldas", sp.BoundingBox(-97.5, 43.0, -89.0, 50.0), 0.125)
_grid("grid_cells_prism", sp.BoundingBox(-96.0, 44.0, -95.0, 45.0), 1 / 24)
_grid("grid_cells_mrms", sp.BoundingBox(-96.0, 44.0, -95.5, 44.5), 0.01)


@query("time_slice", f"{ctes('cells')} SELECT l_orderkey, l_linenumber, time FROM cells WHERE time BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.between(view(spark, sf_dir, "cells"), "1997-01-01", "1997-12-31").select("l_orderkey", "l_linenumber", "time")


@query("station_bbox", f"{ctes('stations')} SELECT station, network, lat, lon FROM stations WHERE lat BETWEEN 44.55e0 AND 45.05e0 AND lon BETWEEN -95.02e0 AND -94.13e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations.in_box(view(spark, sf_dir, "stations"), BOX).select("station", "network", "lat", "lon")


@query("variable_selection", f"{ctes('cells')} SELECT l_orderkey, l_linenumber, round({TC}, 6) AS temperature_c, round(swdown, 6) AS shortwave_wm2, round(rainf, 6) AS precip_mm FROM cells")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "cells").withColumnsRenamed({"tair_k": "Tair", "swdown": "SWdown", "rainf": "Rainf"})
    made = canonical.canonical(raw, "nldas", ("l_orderkey", "l_linenumber"))
    return made.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("temperature_c", "shortwave_wm2", "precip_mm")])


@query("prism_label_shift", f"{ctes('daily_met')} SELECT l_orderkey, l_linenumber, date - INTERVAL '12' HOUR AS time, temp_max_c AS temperature_max_c FROM daily_met")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = view(spark, sf_dir, "daily_met").select("l_orderkey", "l_linenumber", F.col("date").alias("time"), F.col("temp_max_c").alias("tmax"))
    return canonical.canonical(raw, "prism", ("l_orderkey", "l_linenumber", "time"))


# --- joins --------------------------------------------------------------------------------------

_Q = "((1 - {e2}) * (sin(radians({x})) / (1 - {e2} * pow(sin(radians({x})), 2)) - ln((1 - {e1} * sin(radians({x}))) / (1 + {e1} * sin(radians({x})))) / (2 * {e1})))"


def authalic(x: str) -> str:
    return _Q.format(x=x, e2=f"{sp.E2!r}e0", e1=f"{sp.E1!r}e0")


OVERLAPS = f"""
grid AS (SELECT CAST(i AS INT) AS lat_idx, CAST(j AS INT) AS lon_idx, 44e0 + i * 0.1e0 AS s, 44e0 + (i + 1) * 0.1e0 AS n, -96e0 + j * 0.1e0 AS w, -96e0 + (j + 1) * 0.1e0 AS e FROM range(20) a(i), range(30) b(j)),
over AS (SELECT polygon_index, metzone, lat_idx, lon_idx, (least(e, east) - greatest(w, west)) * ({authalic('least(n, north)')} - {authalic('greatest(s, south)')}) AS area,
  (e - w) * ({authalic('n')} - {authalic('s')}) AS cell, (east - west) * ({authalic('north')} - {authalic('south')}) AS whole
  FROM polygons, grid WHERE least(n, north) - greatest(s, south) > 1e-9 AND least(e, east) - greatest(w, west) > 1e-9),
weights AS (SELECT polygon_index, lat_idx, lon_idx, area / cell / sum(area / cell) OVER (PARTITION BY polygon_index) AS weight FROM over)"""
SHIFTED = ctes("polygons").replace("WITH polygons AS (", "WITH fixed AS (") + ", polygons AS (SELECT polygon_index, metzone, south + 0.4e0 AS south, north + 0.4e0 AS north, west, east FROM fixed)"


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.rectangle_overlaps(view(spark, sf_dir, "polygons"), GRID)


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.build_weights(_overlaps(spark, sf_dir), "polygon_index")


@query("polygon_cell_overlap", f"{ctes('polygons')}, {OVERLAPS} SELECT polygon_index, lat_idx, lon_idx, round(area / cell, 6) AS overlap FROM over")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlaps(spark, sf_dir).select("polygon_index", "lat_idx", "lon_idx", F.round("overlap", 6).alias("overlap"))


@query("weightmap", f"{ctes('polygons')}, {OVERLAPS} SELECT polygon_index, lat_idx, lon_idx, round(weight, 6) AS weight FROM weights")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir).select("polygon_index", "lat_idx", "lon_idx", F.round("weight", 6).alias("weight"))


@query("raster_coverage", f"{SHIFTED}, {OVERLAPS} SELECT polygon_index, round(sum(area) / max(whole), 6) AS coverage FROM over GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = view(spark, sf_dir, "polygons").withColumns({"south": F.col("south") + 0.4, "north": F.col("north") + 0.4})
    return sp.rectangle_coverage(sp.rectangle_overlaps(moved, GRID), "polygon_index").select("polygon_index", F.round("coverage", 6).alias("coverage"))


@query("general_polygon_overlap", f"{ctes('polygons')}, {OVERLAPS} SELECT polygon_index, lat_idx, lon_idx, round(area / cell, 5) AS overlap FROM over")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rings = F.array(F.array(point("west", "south"), point("east", "south"), point("east", "north"), point("west", "north")))
    made = sp.polygon_overlaps(view(spark, sf_dir, "polygons").select("polygon_index", rings.alias("rings")), GRID, "polygon_index")
    return made.filter("overlap > 1e-7").select("polygon_index", "lat_idx", "lon_idx", F.round("overlap", 5).alias("overlap"))


@query("dissolve_metzones", f"{ctes('polygons')}, {OVERLAPS} SELECT metzone, lat_idx, lon_idx, round(least(sum(area / cell), 1e0), 6) AS overlap, sum(area / cell) > 1 + 1e-9 AS capped FROM over GROUP BY 1, 2, 3")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.dissolve(_overlaps(spark, sf_dir), "metzone").select("metzone", "lat_idx", "lon_idx", F.round("overlap", 6).alias("overlap"), "capped")


@query("weights_equi_join", f"{ctes('cells', 'polygons')}, {OVERLAPS} SELECT l_orderkey, l_linenumber, polygon_index, round(tair_k * weight, 6) AS part FROM cells JOIN weights USING (lat_idx, lon_idx)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = sp.with_weights(view(spark, sf_dir, "cells"), _weights(spark, sf_dir))
    return joined.select("l_orderkey", "l_linenumber", "polygon_index", F.round(F.col("tair_k") * F.col("weight"), 6).alias("part"))


ZONAL = f"{ctes('cells', 'polygons')}, {OVERLAPS}, grids AS (SELECT lat_idx, lon_idx, time, avg(tair_k) AS tair_k, avg(rainf) AS rainf FROM cells GROUP BY 1, 2, 3)"


def _zonal(spark: SparkSession, sf_dir: str, renormalize: bool) -> DataFrame:
    grids = view(spark, sf_dir, "cells").groupBy("lat_idx", "lon_idx", "time").agg(F.avg("tair_k").alias("tair_k"), F.avg("rainf").alias("rainf"))
    made = sp.zonal_sum(grids, _weights(spark, sf_dir), "polygon_index", ["tair_k", "rainf"], renormalize=renormalize)
    return made.select("polygon_index", "time", F.round("tair_k", 4).alias("tair_k"), F.round("rainf", 4).alias("rainf"))


@query("zonal_weighted_sum", f"{ZONAL} SELECT polygon_index, time, round(sum(tair_k * weight), 4) AS tair_k, round(sum(rainf * weight), 4) AS rainf FROM grids JOIN weights USING (lat_idx, lon_idx) GROUP BY 1, 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zonal(spark, sf_dir, False)


@query("zonal_weighted_mean_renorm", f"{ZONAL} SELECT polygon_index, time, round(sum(tair_k * weight) / sum(weight), 4) AS tair_k, round(sum(rainf * weight) / sum(weight), 4) AS rainf FROM grids JOIN weights USING (lat_idx, lon_idx) GROUP BY 1, 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zonal(spark, sf_dir, True)


@query("bilinear_regrid", """WITH t AS (SELECT s_suppkey AS target_id, 44e0 + (s_suppkey % 37) * 0.05e0 + 0.07e0 AS lat, -96e0 + (s_suppkey % 53) * 0.05e0 + 0.03e0 AS lon FROM supplier),
b AS (SELECT *, (lat - 44e0) / 0.1e0 - 0.5e0 AS y, (lon + 96e0) / 0.1e0 - 0.5e0 AS x FROM t),
c AS (SELECT target_id, CAST(floor(y) AS INT) + di AS lat_idx, CAST(floor(x) AS INT) + dj AS lon_idx,
  (CASE WHEN di = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) * (CASE WHEN dj = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) AS weight FROM b, (VALUES (0), (1)) p(di), (VALUES (0), (1)) r(dj))
SELECT target_id, CAST(lat_idx AS INT) AS lat_idx, CAST(lon_idx AS INT) AS lon_idx, round(weight, 6) AS weight FROM c WHERE lat_idx BETWEEN 0 AND 19 AND lon_idx BETWEEN 0 AND 29 AND weight > 1e-12""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    targets = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(k.alias("target_id"), (44.0 + (k % 37) * 0.05 + 0.07).alias("lat"), (-96.0 + (k % 53) * 0.05 + 0.03).alias("lon"))
    return sp.bilinear_weights(targets, GRID).select("target_id", "lat_idx", "lon_idx", F.round("weight", 6).alias("weight"))


@query("asof_backward", f"{ctes('fine', 'coarse')} SELECT f.zone, f.time, c.time AS label, round(c.precip_mm, 6) AS total FROM fine f ASOF LEFT JOIN coarse c ON f.zone = c.zone AND f.time >= c.time")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = view(spark, sf_dir, "coarse").withColumnRenamed("precip_mm", "total")
    return ti.asof(fine(spark, sf_dir), told, ["zone"], ["total"], label="label").select("zone", "time", "label", F.round("total", 6).alias("total"))


@query("asof_nearest", f"""{ctes('fine', 'coarse')}, back AS (SELECT f.zone, f.time, c.time AS t, c.precip_mm AS v FROM fine f ASOF LEFT JOIN coarse c ON f.zone = c.zone AND f.time >= c.time),
ahead AS (SELECT f.zone, f.time, c.time AS t, c.precip_mm AS v FROM fine f ASOF LEFT JOIN coarse c ON f.zone = c.zone AND f.time <= c.time)
SELECT b.zone, b.time, round(CASE WHEN a.t IS NULL OR (b.t IS NOT NULL AND b.time - b.t <= a.t - b.time) THEN b.v ELSE a.v END, 6) AS total FROM back b JOIN ahead a USING (zone, time)""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = view(spark, sf_dir, "coarse").withColumnRenamed("precip_mm", "total")
    return ti.asof_nearest(fine(spark, sf_dir), told, ["zone"], "total").select("zone", "time", F.round("total", 6).alias("total"))


@query("merge_outer", f"{ctes('fine_gaps', 'coarse')} SELECT zone, time, round(f.precip_mm, 6) AS fine_mm, round(c.precip_mm, 6) AS coarse_mm FROM fine_gaps f FULL JOIN coarse c USING (zone, time)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "fine_gaps").select("zone", "time", F.round("precip_mm", 6).alias("fine_mm"))
    return ti.merge(a, view(spark, sf_dir, "coarse").select("zone", "time", F.round("precip_mm", 6).alias("coarse_mm")), ["zone", "time"])


@query("reindex_fill_zero", f"{ctes('fine')} SELECT zone, time, round(precip_mm, 6) AS precip_mm FROM fine")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fine(spark, sf_dir).select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


@query("index_semi", f"{ctes('fine_gaps', 'coarse')} SELECT zone, time FROM fine_gaps f WHERE EXISTS (SELECT 1 FROM coarse c WHERE c.zone = f.zone AND c.time = f.time)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.in_index(view(spark, sf_dir, "fine_gaps"), view(spark, sf_dir, "coarse"), ["zone", "time"]).select("zone", "time")


@query("missing_dates_anti", "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY)) AS d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date"))
    return ti.missing_labels(have, "1995-01-01", "2001-12-31").select(F.col("date").cast("string").alias("date"))


@query("dsn_lookup", f"{ctes('polygons')} SELECT polygon_index, CAST('10' || CAST(polygon_index AS VARCHAR) AS INT) AS prec_dsn, CAST('16' || CAST(polygon_index AS VARCHAR) AS INT) AS atem_dsn FROM polygons")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.col("polygon_index")
    return view(spark, sf_dir, "polygons").select(zone, store.dsn(F.lit("PREC"), zone).alias("prec_dsn"), store.dsn(F.lit("ATEM"), zone).alias("atem_dsn"))


@query("series_update", f"{ctes('fine_gaps', 'coarse')} SELECT zone, time, round(coalesce(c.precip_mm, f.precip_mm), 6) AS precip_mm FROM fine_gaps f FULL JOIN coarse c USING (zone, time)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.update(view(spark, sf_dir, "fine_gaps"), view(spark, sf_dir, "coarse"), ["zone", "time"]).select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))


# --- aggregates -----------------------------------------------------------------------------------

DAY = "CAST(date_trunc('day', time) AS TIMESTAMP)"


@query("daily_stats", f"{ctes('cells')} SELECT lat_idx, lon_idx, {DAY} AS time, round(avg({TC}), 6) AS tmean, round(min({TC}), 6) AS tmin, round(max({TC}), 6) AS tmax FROM cells GROUP BY 1, 2, 3")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [F.round(f(tc()), 6).alias(n) for n, f in (("tmean", F.avg), ("tmin", F.min), ("tmax", F.max))]
    return ti.resample(view(spark, sf_dir, "cells"), ["lat_idx", "lon_idx"], made)


@query("daily_sum_mj", f"{ctes('cells')} SELECT lat_idx, {DAY} AS time, round(sum(swdown * 0.0036e0), 8) AS solar_mj FROM cells GROUP BY 1, 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.resample(view(spark, sf_dir, "cells"), ["lat_idx"], [F.round(F.coalesce(F.sum(F.col("swdown") * 0.0036), F.lit(0.0)), 8).alias("solar_mj")])


P12 = "CAST(date_trunc('day', time - INTERVAL 12 HOUR) AS TIMESTAMP) + INTERVAL 12 HOUR"


@query("resample_offset_12z", f"{ctes('fine')} SELECT zone, {P12} AS time, round(sum(precip_mm), 4) AS total FROM fine GROUP BY 1, 2")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.resample(fine(spark, sf_dir), ["zone"], [F.round(F.sum("precip_mm"), 4).alias("total")], offset_hours=12)


@query("count_fine_per_coarse", f"{ctes('fine_gaps')} SELECT zone, time, count(*) OVER (PARTITION BY zone, {DAY}) AS n FROM fine_gaps")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.count_per_period(view(spark, sf_dir, "fine_gaps"), ["zone"]).select("zone", "time", "n")


@query("cloud_factor_ratio", f"""{ctes('cells')}, d AS (SELECT lat_idx, lon_idx, {DAY} AS time, sum(swdown) AS rs, sum({GEOMETRIC}) AS rso FROM cells GROUP BY 1, 2, 3)
SELECT lat_idx, lon_idx, time, round(1.35e0 * least(greatest(CASE WHEN rso > 0 THEN rs / nullif(rso, 0) ELSE 1e0 END, 0.25e0), 1e0) - 0.35e0, 6) AS factor FROM d""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = ti.resample(view(spark, sf_dir, "cells"), ["lat_idx", "lon_idx"], [F.sum("swdown").alias("rs"), F.sum(clear()).alias("rso")])
    return sums.select("lat_idx", "lon_idx", "time", F.round(rad.cloud_factor_fao56("rs", "rso"), 6).alias("factor"))


@query("moment_scaling_tau", f"""{ctes('fine')}, p AS (SELECT zone, precip_mm, row_number() OVER (PARTITION BY zone ORDER BY time) - 1 AS p, count(*) OVER (PARTITION BY zone) AS n FROM fine),
s AS (SELECT zone, s, CAST(floor(p / pow(2e0, s)) AS BIGINT) AS g, sum(precip_mm) AS v FROM p, range(6) r(s) WHERE p < n - n % 32 GROUP BY 1, 2, 3),
m AS (SELECT zone, s, q, avg(pow(v, q)) AS m FROM s, (SELECT unnest([0.5e0, 1e0, 1.5e0, 2e0, 2.5e0, 3e0, 3.5e0, 4e0, 4.5e0, 5e0]) AS q) GROUP BY 1, 2, 3)
SELECT zone, q, round(-regr_slope(ln(m), ln(pow(2e0, 5 - s))), 6) AS tau FROM m WHERE m > 0 GROUP BY 1, 2""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cas.moment_scaling(fine(spark, sf_dir), "zone", "precip_mm", step_seconds=3600).select("zone", "q", F.round("tau", 6).alias("tau"))


for _unit, _how, _name, _trunc in (("D", "sum", "dsn_rollup_day", "day"), ("MS", "mean", "dsn_rollup_month", "month"), ("A", "max", "dsn_rollup_year", "year"), ("H", "min", "dsn_rollup_hour", "hour")):

    @query(_name, f"{ctes('cells')} SELECT lat_idx, CAST(date_trunc('{_trunc}', time) AS TIMESTAMP) AS time, round({ {'mean': 'avg'}.get(_how, _how)}(rainf), 4) AS rainf FROM cells GROUP BY 1, 2")
    def _(spark: SparkSession, sf_dir: str, unit: str = _unit, how: str = _how) -> DataFrame:
        return store.roll_up(view(spark, sf_dir, "cells"), ["lat_idx"], "rainf", unit, how).select("lat_idx", "time", F.round("rainf", 4).alias("rainf"))


@query("ratio_residual", f"{ctes('cells')}, d AS (SELECT lat_idx, {DAY} AS time, avg(swdown) AS target, avg({GEOMETRIC}) AS calc FROM cells GROUP BY 1, 2) SELECT lat_idx, time, round(target / nullif(calc, 0), 6) AS ratio, round(target - calc, 6) AS residual FROM d")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = ti.resample(view(spark, sf_dir, "cells"), ["lat_idx"], [F.avg("swdown").alias("target"), F.avg(clear()).alias("calc")])
    return ti.compare(both, "target", "calc").select("lat_idx", "time", F.round("ratio", 6).alias("ratio"), F.round("residual", 6).alias("residual"))


# --- windows and sets ----------------------------------------------------------------------------------


@query("shift_hours", f"{ctes('fine')} SELECT zone, time - INTERVAL 6 HOUR AS label, round(precip_mm, 6) AS precip_mm, round(lead(precip_mm, 6) OVER (PARTITION BY zone ORDER BY time), 6) AS ahead FROM fine")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = fine(spark, sf_dir).withColumn("ahead", F.col("precip_mm"))
    moved = ti.shift_values(full, ["zone"], "ahead", -6)
    return moved.select("zone", (F.col("time") - F.expr("INTERVAL '6' HOUR")).alias("label"), F.round("precip_mm", 6).alias("precip_mm"), F.round("ahead", 6).alias("ahead"))


@query("ffill_daily_to_hourly", f"{ctes('coarse')} SELECT zone, time + INTERVAL 1 HOUR * h AS time, round(precip_mm, 6) AS total FROM coarse, range(24) r(h)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.upsample(view(spark, sf_dir, "coarse"), ["zone"]).select("zone", "time", F.round("precip_mm", 6).alias("total"))


@query("bfill_daily_to_hourly", f"{ctes('fine', 'coarse')} SELECT f.zone, f.time, round(c.precip_mm, 6) AS total FROM fine f ASOF LEFT JOIN coarse c ON f.zone = c.zone AND f.time <= c.time")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = view(spark, sf_dir, "coarse").withColumnRenamed("precip_mm", "total")
    return ti.asof_forward(fine(spark, sf_dir), told, ["zone"], ["total"]).select("zone", "time", F.round("total", 6).alias("total"))


@query("max_time_gap", f"{ctes('fine_gaps')}, g AS (SELECT zone, epoch(time) / 3600e0 - lag(epoch(time) / 3600e0) OVER (PARTITION BY zone ORDER BY time) AS gap FROM fine_gaps) SELECT zone, round(max(gap), 6) AS max_gap_hours FROM g GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ti.gaps(view(spark, sf_dir, "fine_gaps"), ["zone"]).select("zone", F.round("max_gap_hours", 6).alias("max_gap_hours"))


@query("union_allow_missing", f"{ctes('fine_gaps', 'coarse')} SELECT zone, time, round(precip_mm, 6) AS precip_mm, NULL::DOUBLE AS total FROM fine_gaps UNION ALL SELECT zone, time, NULL, round(precip_mm, 6) FROM coarse")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "fine_gaps").select("zone", "time", F.round("precip_mm", 6).alias("precip_mm"))
    return ti.concat([a, view(spark, sf_dir, "coarse").select("zone", "time", F.round("precip_mm", 6).alias("total"))])


def _days(spark: SparkSession, sf_dir: str, table: str, column: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.to_date(column).cast("string").alias("date"))


for _name, _op, _method in (("set_difference", "EXCEPT", "subtract"), ("set_intersect", "INTERSECT", "intersect"), ("set_union", "UNION", "union")):

    @query(_name, f"SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem {_op} SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders")
    def _(spark: SparkSession, sf_dir: str, method: str = _method) -> DataFrame:
        return getattr(_days(spark, sf_dir, "lineitem", "l_shipdate"), method)(_days(spark, sf_dir, "orders", "o_orderdate")).distinct()


@query("distinct_stations", f"{ctes('stations')} SELECT network, count(DISTINCT station) AS n, round(min(lat), 6) AS south, round(max(lat), 6) AS north FROM stations GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = stations.one_per_station(view(spark, sf_dir, "stations"))
    return distinct.groupBy("network").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("lat"), 6).alias("south"), F.round(F.max("lat"), 6).alias("north"))


# --- disaggregation -----------------------------------------------------------------------------------

WEIGHTED = f"""{ctes('fine', 'coarse')}, w AS (SELECT zone, time, {P12} AS p, precip_mm, sum(precip_mm) OVER (PARTITION BY zone, {P12}) AS s, count(*) OVER (PARTITION BY zone, {P12}) AS n, avg(precip_mm) OVER (PARTITION BY zone, {P12}) AS m FROM fine),
j AS (SELECT w.*, c.precip_mm AS c FROM w LEFT JOIN coarse c ON c.zone = w.zone AND c.time = w.p)"""


def _rounded(df: DataFrame, value: str = "precip_mm", keys: tuple[str, ...] = ("zone", "time")) -> DataFrame:
    return df.select(*keys, F.round(value, 6).alias(value))


def _pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fine(spark, sf_dir).withColumnRenamed("precip_mm", "pattern")


@query("disagg_sum_proportional", f"{WEIGHTED} SELECT zone, time, round(CASE WHEN c IS NOT NULL THEN greatest(c * CASE WHEN s > 0 THEN precip_mm / nullif(s, 0) ELSE 1e0 / n END, 0e0) END, 6) AS precip_mm FROM j")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dis.disaggregate(view(spark, sf_dir, "coarse"), "sum", ["zone"], "precip_mm", _pattern(spark, sf_dir), "pattern", offset_hours=12))


@query("disagg_mean_additive", f"{WEIGHTED} SELECT zone, time, round(precip_mm + (c - m), 6) AS precip_mm FROM j")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dis.disaggregate(view(spark, sf_dir, "coarse"), "mean_additive", ["zone"], "precip_mm", _pattern(spark, sf_dir), "pattern", offset_hours=12))


@query("disagg_mean_multiplicative", f"{WEIGHTED} SELECT zone, time, round(CASE WHEN m > 0 THEN {clipped('precip_mm * (c / nullif(m, 0))', '0e0')} ELSE c END, 6) AS precip_mm FROM j")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dis.disaggregate(view(spark, sf_dir, "coarse"), "mean_multiplicative", ["zone"], "precip_mm", _pattern(spark, sf_dir), "pattern", offset_hours=12))


@query("disagg_custom_weights", f"{WEIGHTED} SELECT zone, time, round(CASE WHEN c IS NOT NULL THEN greatest(c * (0.01e0 + precip_mm / 1e4), 0e0) END, 6) AS precip_mm FROM j")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    custom = fine(spark, sf_dir).select("zone", "time", (0.01 + F.col("precip_mm") / 1e4).alias("share"))
    return _rounded(dis.disaggregate(view(spark, sf_dir, "coarse"), "sum", ["zone"], "precip_mm", custom, "share", "custom", offset_hours=12))


PET_DAILY = f"{ctes('daily_met')}, daily AS (SELECT CAST(round((lat - 44e0) * 10 - 0.5e0) AS INT) % 3 AS zone, date AS time, avg(solar_mj) / 2.45e0 AS pet_mm, max(lat) AS lat FROM daily_met GROUP BY 1, 2), hours AS (SELECT zone, time AS p, time + INTERVAL 1 HOUR * h AS time, pet_mm, lat FROM daily, range(24) r(h))"
TRAP_LONG = "(7.6394e0 * acos(least(greatest(-tan(radians(lat)) * tan(0.40928e0 * cos(0.0172141e0 * (172e0 - dayofyear(time)))), -1e0), 1e0)))"


def _pet_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    met = view(spark, sf_dir, "daily_met")
    return met.groupBy((F.round((F.col("lat") - 44.0) * 10 - 0.5).cast("int") % 3).alias("zone"), F.col("date").alias("time")).agg((F.avg("solar_mj") / 2.45).alias("pet_mm"), F.max("lat").alias("lat"))


@query("disagg_sum_trapezoidal", f"""{PET_DAILY}, g AS (SELECT *, abs(hour(time) - 12e0) AS noon, {TRAP_LONG} / 2 AS half FROM hours),
t AS (SELECT *, CASE WHEN half > 0 THEN (2e0 / 3) / half * least(greatest((half - noon) / (half / 2), 0e0), 1e0) ELSE 0e0 END AS f FROM g)
SELECT zone, time, round(pet_mm * f / sum(f) OVER (PARTITION BY zone, p), 6) AS pet_mm FROM t""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dis.disaggregate_pet_trapezoidal(_pet_daily(spark, sf_dir), keys=["zone"], value="pet_mm", lat="lat"), "pet_mm")


@query("disagg_sum_solar", f"{PET_DAILY}, e AS (SELECT zone, p, time, pet_mm, {SUN} AS sun FROM (SELECT *, -95e0 + zone AS lon FROM hours) h), f AS (SELECT zone, p, time, pet_mm, {ineichen('sun')} AS f FROM e) SELECT zone, time, round(pet_mm * f / sum(f) OVER (PARTITION BY zone, p), 6) AS pet_mm FROM f")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _pet_daily(spark, sf_dir).withColumn("lon", -95.0 + F.col("zone"))
    return _rounded(dis.disaggregate_pet_solar(daily, keys=["zone"], value="pet_mm", lat="lat", lon="lon"), "pet_mm")


@query("pevt_diurnal", f"{PET_DAILY} SELECT zone, time, round(pet_mm * ([{', '.join(f'{x}e0' for x in dis.DIURNAL)}])[hour(time) + 1] / {sum(dis.DIURNAL)!r}e0, 6) AS pevt_hourly FROM hours")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(dis.disaggregate_pevt(_pet_daily(spark, sf_dir), ["zone"], "pet_mm"), "pevt_hourly")


@query("pevt_static", f"{PET_DAILY} SELECT zone, time, round(pet_mm * (1e0 / 24), 9) AS pevt_hourly FROM hours")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = dis.disaggregate_pevt(_pet_daily(spark, sf_dir), ["zone"], "pet_mm", "static")
    return made.select("zone", "time", F.round("pevt_hourly", 9).alias("pevt_hourly"))


@query("pet_daily_to_hourly_solar", f"""{PET_DAILY}, s AS (SELECT *, CASE WHEN hour(time) BETWEEN 7 AND 17 AND dayofyear(time) % 5 <> 0 THEN (hour(time) * 7 % 11) * 1e1 ELSE 0e0 END AS lit FROM hours),
t AS (SELECT *, sum(lit) OVER (PARTITION BY zone, p) AS total FROM s) SELECT zone, time, round(CASE WHEN total > 0 THEN pet_mm * lit / nullif(total, 0) ELSE 0e0 END, 6) AS pet_mm FROM t""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _pet_daily(spark, sf_dir)
    hour = F.hour("time")
    hourly = ti.upsample(daily.select("zone", "time"), ["zone"]).withColumns({"sw": (hour * 7 % 11) * 10.0, "day": hour.between(7, 17) & (F.dayofyear("time") % 5 != 0)})
    return _rounded(dis.pet_by_daylight(daily, hourly, ["zone"], "pet_mm", "sw", "day"), "pet_mm")


@query("hash_uniform", f"{ctes('stations')} SELECT station, round(CAST('0x' || substr(md5('7|' || station), 1, 8) AS UBIGINT) / 4294967296e0, 9) AS u FROM stations")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "stations").select("station", F.round(hash_uniform(F.lit(7), F.col("station")), 9).alias("u"))


#: Cascade parameters that differ from zone to zone, the same in both engines.
PARAMETERS = "cascade_parameters AS (SELECT zone, 1.2e0 + 0.1e0 * zone AS amplitude, 0.3e0 + 0.05e0 * zone AS beta, 0.1e0 + 0.1e0 * zone AS tau0 FROM (SELECT CAST(z AS INT) AS zone FROM range(4) t(z)))"


def _parameters(spark: SparkSession) -> DataFrame:
    """Zones 0 to 3; zone 4 takes the default."""
    zone = F.col("id").cast("int")
    return spark.range(4).select(zone.alias("zone"), (1.2 + 0.1 * zone).alias("amplitude"), (0.3 + 0.05 * zone).alias("beta"), (0.1 + 0.1 * zone).alias("tau0"))


def cascade_sql(source: str, seed: str = "0", more: str = "", levels: int = 5) -> str:
    """CTEs l0 to l<levels> over source(zone, time, value), with the parameters of each zone."""
    p = cas.DEFAULT
    u = lambda j: f"(CAST('0x' || substr(m, {6 * j + 1}, 6) AS UBIGINT) / 16777216e0)"
    total, cuts = 0.0, []
    for k in range(8):
        total += math.exp(-1) / math.factorial(k)
        cuts.append(total)
    poisson = lambda x: "CASE " + " ".join(f"WHEN {x} < {c!r}e0 THEN {k}" for k, c in enumerate(cuts)) + " ELSE 8 END"
    w = lambda x: f"(amplitude * pow(beta, {poisson(x)}))"
    dry = "(1 - pow(2e0, tau0 - 1))"
    told = ", ".join(f"coalesce(x.{c}, {getattr(p, c)!r}e0) AS {c}" for c in ("amplitude", "beta", "tau0"))
    out = [PARAMETERS, f"p0 AS (SELECT s.*, {told} FROM {source} s LEFT JOIN cascade_parameters x ON x.zone = s.zone)"]
    out.append(f"l0 AS (SELECT zone, time{more}, CAST(0 AS BIGINT) AS idx, value, amplitude, beta, 1 - least(greatest({dry} * (1 + {dry}), 0e0), 1e0) AS wet FROM p0 WHERE value > 0)")
    for k in range(levels):
        out.append(f"m{k} AS (SELECT *, md5({seed} || '|' || zone || '|' || CAST(epoch(time) AS BIGINT) || '|{k}|' || idx) AS m FROM l{k})")
        out.append(f"u{k} AS (SELECT *, {', '.join(f'{u(j)} AS u{j}' for j in range(5))} FROM m{k})")
        out.append(f"w{k} AS (SELECT *, CASE WHEN u2 < wet OR (NOT u2 < wet AND NOT u3 < wet AND u4 < 0.5e0) THEN {w('u0')} ELSE 0e0 END AS a, CASE WHEN u3 < wet OR (NOT u2 < wet AND NOT u3 < wet AND u4 >= 0.5e0) THEN {w('u1')} ELSE 0e0 END AS b FROM u{k})")
        out.append(f"l{k + 1} AS (SELECT zone, time{more}, idx * 2 + h AS idx, value * CASE WHEN h = 0 THEN CASE WHEN a + b > 0 THEN a / nullif(a + b, 0) ELSE 0.5e0 END ELSE 1 - CASE WHEN a + b > 0 THEN a / nullif(a + b, 0) ELSE 0.5e0 END END AS value, amplitude, beta, wet FROM w{k}, range(2) r(h))")
    out.append(f"drawn AS (SELECT zone, time AS period{more}, time + INTERVAL 1 HOUR * CAST(floor(q / 4) AS INT) AS time, sum(value / 3e0) AS value FROM (SELECT *, idx * 3 + k AS q FROM l{levels}, range(3) r(k)) GROUP BY ALL)")
    return ", ".join(out)


@query("cascade_split_hash", f"{ctes('coarse')}, src AS (SELECT zone, time, precip_mm AS value FROM coarse), {cascade_sql('src')} SELECT zone, time, idx, round(value, 6) AS value FROM l5")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cas.cascade(view(spark, sf_dir, "coarse"), "zone", "precip_mm", _parameters(spark)).select("zone", "time", "idx", F.round("value", 6).alias("value"))


@query("cascade_45_to_60", f"{ctes('coarse')}, src AS (SELECT zone, time, precip_mm AS value FROM coarse), {cascade_sql('src')} SELECT zone, time, round(value, 6) AS precip_mm FROM drawn")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cas.to_hours(cas.cascade(view(spark, sf_dir, "coarse"), "zone", "precip_mm", _parameters(spark)), "zone", "precip_mm"))


DRY = "CASE WHEN dayofyear(time - INTERVAL 12 HOUR) % 3 = 0 THEN 0e0 ELSE precip_mm END"
HYBRID = f"""{ctes('fine', 'coarse')}, f AS (SELECT zone, time, {P12} AS p, {DRY} AS v FROM fine), w AS (SELECT *, sum(v) OVER (PARTITION BY zone, p) AS s FROM f),
j AS (SELECT w.*, CASE WHEN dayofyear(c.time) % 7 = 0 THEN 0e0 ELSE c.precip_mm END AS c FROM w LEFT JOIN coarse c ON c.zone = w.zone AND c.time = w.p),
src AS (SELECT DISTINCT zone, p AS time, c AS value FROM j WHERE c > 0 AND s <= 0)"""


def _hybrid_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    dry = F.dayofyear(F.col("time") - F.expr("INTERVAL '12' HOUR")) % 3 == 0
    pattern = fine(spark, sf_dir).withColumn("precip_mm", F.when(dry, 0.0).otherwise(F.col("precip_mm")))
    totals = view(spark, sf_dir, "coarse").withColumn("precip_mm", F.when(F.dayofyear("time") % 7 == 0, 0.0).otherwise(F.col("precip_mm")))
    return totals, pattern


for _name, _keep, _else in (("precip_hybrid", True, "0e0"), ("precip_hybrid_keep_pattern", False, "v")):

    @query(_name, f"{HYBRID}, {cascade_sql('src')} SELECT j.zone, j.time, round(CASE WHEN c > 0 AND s > 0 THEN c * (v / nullif(s, 0)) WHEN c > 0 THEN coalesce(d.value, 0e0) WHEN c <= 0 AND s > 0 THEN {_else} ELSE 0e0 END, 6) AS precip_mm FROM j LEFT JOIN drawn d ON d.zone = j.zone AND d.time = j.time AND d.period = j.p")
    def _(spark: SparkSession, sf_dir: str, enforce: bool = _keep) -> DataFrame:
        return _rounded(cas.hybrid(*_hybrid_inputs(spark, sf_dir), "zone", "precip_mm", _parameters(spark), offset_hours=12, enforce_coarse_mass=enforce))


#: The realisations of the operator's default and of the reference.
RUNS = 500
MONTE = f"""{HYBRID}, days AS (SELECT zone, time, value, r AS realization FROM src, range(1, {RUNS + 1}) x(r)), {cascade_sql('days', 'realization', ', realization')},
full_ AS (SELECT d.zone, d.time AS period, d.realization, h AS hour, coalesce(c.value, 0e0) AS v FROM days d CROSS JOIN range(24) r(h) LEFT JOIN drawn c ON c.zone = d.zone AND c.period = d.time AND c.realization = d.realization AND c.time = d.time + INTERVAL 1 HOUR * h)"""


def _monte_carlo(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return cas.monte_carlo(*_hybrid_inputs(spark, sf_dir), "zone", "precip_mm", RUNS, 0.1, _parameters(spark), offset_hours=12)


@query("monte_carlo_summary", f"{MONTE} SELECT zone, period AS day, CAST(hour AS INT) AS hour, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(CASE WHEN avg(v) > 0 THEN stddev_pop(v) / nullif(avg(v), 0) END, 6) AS cv, round(quantile_cont(v, 0.05e0), 6) AS q05, round(quantile_cont(v, 0.25e0), 6) AS q25, round(quantile_cont(v, 0.5e0), 6) AS q50, round(quantile_cont(v, 0.75e0), 6) AS q75, round(quantile_cont(v, 0.95e0), 6) AS q95 FROM full_ GROUP BY 1, 2, 3")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly, _ = _monte_carlo(spark, sf_dir)
    return hourly.select("zone", "day", "hour", *[F.round(c, 6).alias(c) for c in ("mean", "std", "cv", "q05", "q25", "q50", "q75", "q95")])


@query("monte_carlo_daily", f"""{MONTE}, runs AS (SELECT zone, period, realization, max(v) AS peak, arg_max(hour, (round(v, 9), -hour)) AS peak_hour, sum(CASE WHEN round(v, 9) >= 0.1e0 THEN 1 ELSE 0 END) AS wet FROM full_ GROUP BY 1, 2, 3)
SELECT zone, period AS day, round(avg(peak), 6) AS peak_mean, round(stddev_pop(peak), 6) AS peak_std, round(avg(peak_hour), 6) AS peak_hour_mean, round(stddev_pop(peak_hour), 6) AS peak_hour_std, round(avg(wet), 6) AS wet_hours_mean, round(stddev_pop(wet), 6) AS wet_hours_std FROM runs GROUP BY 1, 2""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, daily = _monte_carlo(spark, sf_dir)
    return daily.select("zone", "day", *[F.round(c, 6).alias(c) for c in daily.columns if c not in ("zone", "day")])


@query("cascade_fit")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cas.fitted(fine(spark, sf_dir), "zone", "precip_mm")


@query("precip_hybrid_fitted")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hybrid rule with each zone's cascade fitted to its own fine series."""
    return _rounded(cas.disaggregate_precipitation(*_hybrid_inputs(spark, sf_dir), "zone", "precip_mm", offset_hours=12))


# --- sources and texts ------------------------------------------------------------------------------------


@query("html_station_regex", r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, CAST(len(regexp_extract_all(html, '<li><a href="([^"]*)"')) AS INT) AS links FROM pages WHERE html IS NOT NULL AND regexp_extract(html, '<title>([^<]*)</title>', 1) <> ''""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = stations.html_fields(pages, "html", {"title": "<title>([^<]*)</title>", "lang": '<html lang="([a-z]+)"'}, ("title",))
    return found.select("page_id", "title", "lang", F.size(F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'))).alias("links"))


@query("geojson_explode", f"{ctes('stations')} SELECT CAST(station AS VARCHAR) AS stid, name, round(lat, 6) AS lat, round(lon, 6) AS lon, elevation_m AS elevation, CAST(network AS VARCHAR) AS network FROM stations WHERE lat BETWEEN 44.55e0 AND 45.05e0 AND lon BETWEEN -95.02e0 AND -94.13e0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = view(spark, sf_dir, "stations")
    feature = F.struct(F.struct(F.col("station").cast("string").alias("sid"), F.col("name").alias("sname"), F.col("elevation_m").alias("elevation"), F.col("network").cast("string").alias("network")).alias("properties"), F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"))
    texts = st.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("json"))
    found = stations.geojson_stations(texts, "json", BOX)
    return found.select("stid", "name", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "elevation", "network")


@query("column_normalise", "SELECT DISTINCT p_type, regexp_replace(regexp_replace(lower(trim(p_type)), '[^0-9a-z]+', '_', 'g'), '^_+|_+$', '', 'g') AS clean FROM part")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_type", stations.clean_text(F.col("p_type")).alias("clean")).distinct()


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", stations.json_field("props", "k", "int").alias("k"))


@query("cache_audit", f"""{ctes('cells')}, u AS (SELECT {DAY} AS unit, count(DISTINCT time) AS steps, list_sort(list_distinct(list((lat_idx, lon_idx)))) AS shape FROM cells GROUP BY 1)
SELECT unit, steps, CAST(len(shape) AS INT) AS cells, steps < 3 OR shape <> (SELECT arg_max(shape, (len(shape), CAST(unit AS VARCHAR))) FROM u) AS bad FROM u""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.audit(view(spark, sf_dir, "cells"), ti.period_start(F.col("time")), 3)


@query("station_codes", f"{ctes('stations')} SELECT station, lpad(CAST(station AS VARCHAR), 6, '0') AS code, CAST(substr(lpad(CAST(station AS VARCHAR), 6, '0'), 3) AS INT) AS number, strftime(DATE '2001-01-01' + CAST(station % 365 AS INT), '%Y%m%d') AS stamp FROM stations")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = stations.grid_code(F.col("station"), 6)
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("station") % 365).cast("int"))
    return view(spark, sf_dir, "stations").select("station", code.alias("code"), stations.from_grid_code(code, 3, 6).alias("number"), F.date_format(day, "yyyyMMdd").alias("stamp"))


# --- recipes ----------------------------------------------------------------------------------------------

def forcing_sql(wind: str) -> str:
    """CTEs up to shares (hourly zone values with each hour's share of its day) and pets (daily zone values)."""
    return f"""{ctes('cells', 'polygons', 'daily_rain')}, {OVERLAPS},
raw AS (SELECT lat_idx, lon_idx, time, avg(tair_k) AS tair_k, avg(qair) AS qair, avg(psurf_pa) AS psurf_pa, avg(wind_e) AS wind_e, avg(wind_n) AS wind_n, avg(swdown) AS swdown, avg(rainf) AS rainf,
  44e0 + (lat_idx + 0.5e0) * 0.1e0 AS lat, -96e0 + (lon_idx + 0.5e0) * 0.1e0 AS lon FROM cells GROUP BY 1, 2, 3),
hourly AS (SELECT lat_idx, lon_idx, lat, time, {TC} AS t, {DEW} AS d, {wind} AS u, swdown AS sw, rainf AS p, {SUN} AS sun FROM raw),
clear AS (SELECT *, {ineichen('sun')} AS cs FROM hourly),
covered AS (SELECT *, CASE WHEN sun >= 10 THEN {clipped(f'sqrt((1 - {clipped("sw / nullif(cs, 0)", "0e0", "1e0")}) / 0.6e0)', '0e0', '1e0')} END AS cover FROM clear),
stats AS (SELECT lat_idx, lon_idx, lat, {DAY} AS time, avg(t) AS temp_mean_c, avg(d) AS temp_dew_c, avg(u) AS wind_ms, sum(sw * 0.0036e0) AS solar_mj, avg(cover) AS cover FROM covered GROUP BY 1, 2, 3, 4),
zones AS (SELECT polygon_index, time, sum(t * weight) AS t, sum(d * weight) AS d, sum(u * weight) AS u, sum(sw * weight) AS sw, sum(p * weight) AS p FROM hourly JOIN weights USING (lat_idx, lon_idx) GROUP BY 1, 2),
pets AS (SELECT polygon_index, time, sum({KNB} * weight) AS pet, sum(greatest({extra('time')} / 2.45e0 / 100 * (temp_mean_c + 5), 0e0) * weight) AS oudin, coalesce(sum(cover * weight), 0e0) AS cover FROM stats JOIN weights USING (lat_idx, lon_idx) GROUP BY 1, 2),
shares AS (SELECT *, {DAY} AS day, CASE WHEN sum(sw) OVER (PARTITION BY polygon_index, {DAY}) > 0 THEN sw / nullif(sum(sw) OVER (PARTITION BY polygon_index, {DAY}), 0) ELSE 1e0 / count(*) OVER (PARTITION BY polygon_index, {DAY}) END AS share FROM zones)"""


UNITS = """round(t * 9 / 5 + 32, 4) AS temperature_f, round(d * 9 / 5 + 32, 4) AS dewpoint_f, round(u * 2.23694e0, 4) AS wind_speed_mph, round(sw / 11.63e0, 4) AS shortwave_langley,
  round(sw * 0.0864e0, 4) AS shortwave_mj_day, round(cover * 10, 4) AS cloud_cover_tenths, round(greatest(pet * share, 0e0) / 25.4e0, 4) AS pet_in"""


@query("recipe_nldas", f"""{forcing_sql(f"{SPEED} * (ln(67.8e0 * 2 - 5.42e0) / ln(67.8e0 * 10 - 5.42e0))")}
SELECT s.polygon_index, s.time - INTERVAL 6 HOUR AS time, {UNITS}, round(p / 25.4e0, 4) AS precip_in, round(greatest(oudin * share, 0e0) / 25.4e0, 4) AS oudin_in
FROM shares s JOIN pets x ON x.polygon_index = s.polygon_index AND x.time = s.day""")
def recipe_nldas(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = recipes.forcing(view(spark, sf_dir, "cells"), view(spark, sf_dir, "polygons"), GRID)
    return made.select("polygon_index", "time", *[F.round(c, 4).alias(c) for c in made.columns if c not in ("polygon_index", "time")])


RAIN_WEIGHTS = OVERLAPS.replace("grid AS", "rgrid AS").replace("over AS", "rover AS").replace("weights AS", "rweights AS").replace("FROM polygons, grid", "FROM polygons, rgrid").replace("FROM over", "FROM rover").replace("0.1e0", "0.2e0").replace("range(20)", "range(10)").replace("range(30)", "range(15)")


@query("recipe_hybrid", f"""{forcing_sql(SPEED)}, {RAIN_WEIGHTS},
totals AS (SELECT polygon_index AS zone, time, sum(precip_mm * weight) AS c FROM daily_rain JOIN rweights USING (lat_idx, lon_idx) GROUP BY 1, 2),
placed AS (SELECT s.*, s.polygon_index AS zone, pet, cover, p AS v, {P12.replace('time', 's.time')} AS per FROM shares s JOIN pets x ON x.polygon_index = s.polygon_index AND x.time = s.day),
summed AS (SELECT *, sum(v) OVER (PARTITION BY zone, per) AS total FROM placed),
j AS (SELECT m.*, c FROM summed m LEFT JOIN totals o ON o.zone = m.zone AND o.time = m.per),
src AS (SELECT DISTINCT zone, per AS time, c AS value FROM j WHERE c > 0 AND total <= 0), {cascade_sql('src')}
SELECT j.polygon_index, j.time, {UNITS}, round(CASE WHEN c > 0 AND total > 0 THEN c * (v / nullif(total, 0)) WHEN c > 0 THEN coalesce(r.value, 0e0) WHEN c <= 0 AND total > 0 THEN v ELSE 0e0 END / 25.4e0, 4) AS precip_in
FROM j LEFT JOIN drawn r ON r.zone = j.zone AND r.time = j.time AND r.period = j.per""")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _parameters(spark).withColumnRenamed("zone", "polygon_index")
    made = recipes.hybrid_forcing(view(spark, sf_dir, "cells"), view(spark, sf_dir, "daily_rain"), view(spark, sf_dir, "polygons"), GRID, RAIN_GRID, parameters=told)
    return made.select("polygon_index", "time", *[F.round(c, 4).alias(c) for c in made.columns if c not in ("polygon_index", "time")])
