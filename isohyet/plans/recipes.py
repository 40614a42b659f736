"""From gridded forcing to zone series in the units of hydrologic models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.functions.cols import Number, clip, col
from isohyet.functions.evaporation import oudin, penman_knb
from isohyet.functions.radiation import clearsky_ineichen, cloud_cover_davis, solar_elevation
from isohyet.functions.thermo import adjust_wind_height, celsius_to_fahrenheit, dewpoint_august_roche_magnus, kelvin_to_celsius, wind_speed
from isohyet.operators.cascade import CascadeParameters, fitted, hybrid
from isohyet.operators.disaggregate import normalise
from isohyet.operators.spatial import BROADCAST_WEIGHTS, Grid, build_weights, rectangle_overlaps, zonal_sum
from isohyet.operators.store import cut
from isohyet.operators.time import hours, period_start

HOURLY = ("temperature_c", "dewpoint_c", "wind_speed_ms", "shortwave_wm2", "longwave_wm2", "precip_mm")
DAILY = ("pet_mm", "oudin_mm", "cloud_cover")


def derive_hourly(cells: DataFrame, adjust_wind: bool = True) -> DataFrame:
    """Mean of each cell and hour, then derived variables."""
    raw = cells.groupBy("lat_idx", "lon_idx", "time").agg(*[F.avg(c).alias(c) for c in ("tair_k", "qair", "psurf_pa", "wind_e", "wind_n", "swdown", "lwdown", "rainf")])
    speed = wind_speed("wind_e", "wind_n")
    return raw.select(
        "lat_idx", "lon_idx", "time", kelvin_to_celsius("tair_k").alias("temperature_c"), dewpoint_august_roche_magnus("qair", "psurf_pa").alias("dewpoint_c"),
        (adjust_wind_height(speed) if adjust_wind else speed).alias("wind_speed_ms"), F.col("swdown").alias("shortwave_wm2"), F.col("lwdown").alias("longwave_wm2"), F.col("rainf").alias("precip_mm"),
    )


def with_cloud(hourly: DataFrame, grid: Grid, k: float = 0.6) -> DataFrame:
    """cloud_cover of each cell and hour from shortwave against the clear sky; none while the sun is low."""
    lat, lon = grid.south + (F.col("lat_idx") + 0.5) * grid.dlat, grid.west + (F.col("lon_idx") + 0.5) * grid.dlon
    up = hourly.withColumn("_sun", solar_elevation(F.col("time"), lat, lon))
    clear = up.withColumn("_clear", clearsky_ineichen("_sun", F.col("time")))
    return clear.withColumn("cloud_cover", cloud_cover_davis("shortwave_wm2", "_clear", "_sun", k)).drop("_sun", "_clear")


def derive_daily(hourly: DataFrame, grid: Grid) -> DataFrame:
    """Daily statistics of each cell, the evaporation of a pan and by temperature, and the mean cloud cover."""
    daily = with_cloud(hourly, grid).groupBy("lat_idx", "lon_idx", period_start(F.col("time")).alias("time")).agg(
        F.avg("temperature_c").alias("tmean"), F.min("temperature_c").alias("tmin"), F.max("temperature_c").alias("tmax"), F.avg("dewpoint_c").alias("tdew"),
        F.avg("wind_speed_ms").alias("wind"), F.coalesce(F.sum(F.col("shortwave_wm2") * 0.0036), F.lit(0.0)).alias("solar_mj"), F.avg("cloud_cover").alias("cloud_cover"),
    )
    lat = grid.south + (F.col("lat_idx") + 0.5) * grid.dlat
    return daily.withColumns({"pet_mm": penman_knb("tmean", "tdew", "wind", "solar_mj"), "oudin_mm": oudin(F.col("time"), "tmean", lat)})


def zonal(cells: DataFrame, rectangles: DataFrame, grid: Grid, key: str, adjust_wind: bool) -> tuple[DataFrame, DataFrame]:
    """Hourly and daily zone series; cells outside all polygons go before anything is shuffled, and the weights are made once."""
    weights = build_weights(rectangle_overlaps(rectangles, grid), key)
    weights = cut(weights)  # used four times; the table is as small as its polygons' cells
    n = weights.count()
    touched = weights.select("lat_idx", "lon_idx").distinct()
    inside = cells.join(F.broadcast(touched) if n <= BROADCAST_WEIGHTS else touched, ["lat_idx", "lon_idx"], "left_semi")
    hourly = derive_hourly(inside, adjust_wind)
    daily = zonal_sum(derive_daily(hourly, grid), weights, key, list(DAILY), n_weights=n)
    return zonal_sum(hourly, weights, key, list(HOURLY), n_weights=n), daily


def spread_daily(hourly: DataFrame, daily: DataFrame, key: str) -> DataFrame:
    """Hourly rows with the day's evaporation by their share of shortwave, and the day's cloud cover."""
    told = daily.select(key, F.col("time").alias("_day"), *[F.col(c).alias(f"_{c}") for c in DAILY])
    shares = normalise(hourly, [key], F.col("shortwave_wm2"))
    met = shares.withColumn("_day", period_start(F.col("time"))).join(told, [key, "_day"])
    spread = {c: clip(F.col(f"_{c}") * F.col("weight"), 0.0) for c in ("pet_mm", "oudin_mm")}
    return met.withColumns(spread | {"cloud_cover": F.col("_cloud_cover")}).drop("_day", "weight", *[f"_{c}" for c in DAILY])


def hspf_units(temperature_c: Number, dewpoint_c: Number, wind_ms: Number, shortwave_wm2: Number, cloud: Number, pet_mm: Number, precip_mm: Number) -> dict[str, Column]:
    return {
        "temperature_f": celsius_to_fahrenheit(temperature_c), "dewpoint_f": celsius_to_fahrenheit(dewpoint_c), "wind_speed_mph": col(wind_ms) * 2.23694,
        "shortwave_langley": col(shortwave_wm2) / 11.63, "shortwave_mj_day": col(shortwave_wm2) * 0.0864, "cloud_cover_tenths": col(cloud) * 10,
        "pet_in": col(pet_mm) / 25.4, "precip_in": col(precip_mm) / 25.4,
    }


def forcing(cells: DataFrame, rectangles: DataFrame, grid: Grid, key: str = "polygon_index", shift_hours: int = -6) -> DataFrame:
    """Hourly zone series: weights, zonal sums of hourly and daily variables, evaporation by shortwave, cloud cover, model units, local labels."""
    hourly, daily = zonal(cells, rectangles, grid, key, adjust_wind=True)
    spread = spread_daily(hourly, daily, key)
    units = hspf_units("temperature_c", "dewpoint_c", "wind_speed_ms", "shortwave_wm2", "cloud_cover", "pet_mm", "precip_mm")
    units["oudin_in"] = F.col("oudin_mm") / 25.4
    return spread.select(key, (F.col("time") + hours(shift_hours)).alias("time"), *[v.alias(k) for k, v in units.items()])


def hybrid_forcing(
    cells: DataFrame, daily_rain: DataFrame, rectangles: DataFrame, grid: Grid, rain_grid: Grid, key: str = "polygon_index", offset_hours: int = 12,
    parameters: CascadeParameters | DataFrame | None = None,
) -> DataFrame:
    """As ``forcing``, with the rain of a second, daily grid (precip_mm, labelled at the start of its days): by the pattern of the
    first grid's hours, by the cascade where these are dry, and theirs where the daily grid is dry; wind as measured, labels in UTC.

    Cascade parameters are fitted to each zone's hours unless given.
    """
    hourly, daily = zonal(cells, rectangles, grid, key, adjust_wind=False)
    totals = zonal_sum(daily_rain, build_weights(rectangle_overlaps(rectangles, rain_grid), key), key, ["precip_mm"])
    hourly = cut(hourly)  # the fit, the pattern and the day's shares read it again
    parameters = fitted(hourly, key, "precip_mm") if parameters is None else parameters
    rain = hybrid(totals, spread_daily(hourly, daily, key), key, "precip_mm", parameters, offset_hours=offset_hours, enforce_coarse_mass=False)
    units = hspf_units("temperature_c", "dewpoint_c", "wind_speed_ms", "shortwave_wm2", "cloud_cover", "pet_mm", "precip_mm")
    return rain.select(key, "time", *[v.alias(k) for k, v in units.items()])
