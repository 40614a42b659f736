"""Variants of the operators that an older, desktop form of the same models used.

They differ in details that results depend on: region fractions in place of cell
weights (``spatial.region_fractions``), components of wind averaged before the speed,
labels at the end of periods, and other constants.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.functions.cols import Number, clip, col, ratio
from isohyet.functions.thermo import celsius_to_fahrenheit, dewpoint_from_specific_humidity_cc, kelvin_to_fahrenheit, vapor_pressure_lamoreux, wind_speed
from isohyet.operators.cascade import DEFAULT, CascadeParameters, cascade, fitted, hybrid, to_hours
from isohyet.operators.disaggregate import solar_plateau
from isohyet.operators.spatial import BoundingBox, contained
from isohyet.operators.time import hours, period_start, upsample


def penman_pan(tmin_f: Number, tmax_f: Number, dew_f: Number, wind_miles: Number, solar_ly: Number) -> Column:
    """Daily pan evaporation in inches: the mean of the extreme temperatures, solar radiation of 1e-5 langleys at least."""
    t = (col(tmin_f) + col(tmax_f)) / 2
    solar = F.when(col(solar_ly) <= 0, 0.00001).otherwise(col(solar_ly))
    radiant = F.exp((t - 212) * (0.1024 - 0.01066 * F.log(solar))) - 0.0001
    moved = 0.0105 * F.pow(clip(vapor_pressure_lamoreux(t) - vapor_pressure_lamoreux(dew_f), 0.0), 0.88) * (0.37 + 0.0041 * col(wind_miles))
    slope = 47987800000.0 * F.exp(ratio(-7482.6, t + 398.36)) / ((t + 398.36) * (t + 398.36))
    return clip(ratio(radiant + moved, slope + 0.0105), 0.0)


def day_share(time: Column, lat: Column) -> Column:
    """The hour's share of a day's evaporation, as it comes: shares of a day need not sum to 1.  Days count 30.5 to the month."""
    return solar_plateau(F.hour(time).cast("double"), 30.5 * (F.month(time) - 1) + F.dayofmonth(time), lat, 0.66666667)


def zone_hours(cells: DataFrame, fractions: DataFrame, key: str, utc_offset: int = 6) -> DataFrame:
    """Local hourly zone series: variables are spread by region fractions first, then derived (wind from mean components, at 2 m)."""
    raw = cells.join(fractions, ["lat_idx", "lon_idx"]).groupBy(key, "time").agg(*[F.sum(F.col(v) * F.col("fraction")).alias(v) for v in ("tair_k", "qair", "psurf_pa", "wind_e", "wind_n", "swdown", "rainf")])
    return raw.select(
        key, (F.col("time") - hours(utc_offset)).alias("time"), kelvin_to_fahrenheit("tair_k").alias("temperature_f"), celsius_to_fahrenheit(dewpoint_from_specific_humidity_cc("qair", "psurf_pa")).alias("dewpoint_f"),
        (wind_speed("wind_e", "wind_n") * 0.2**0.143 * 2.23694).alias("wind_miles"), (F.col("swdown") / 11.63).alias("solar_ly"), F.col("rainf").alias("precip_mm"),
    )


def zone_evaporation(hourly: DataFrame, key: str) -> DataFrame:
    """Daily pan evaporation (inches) of hourly zone series: extreme temperatures, mean dewpoint, sums of wind and sun."""
    day = period_start(F.col("time"))
    daily = hourly.groupBy(key, day.alias("time")).agg(
        F.min("temperature_f").alias("_low"), F.max("temperature_f").alias("_high"), F.avg("dewpoint_f").alias("_dew"), F.sum("wind_miles").alias("_wind"), F.sum("solar_ly").alias("_sun")
    )
    return daily.select(key, "time", penman_pan("_low", "_high", "_dew", "_wind", "_sun").alias("pan_in"))


def spread_evaporation(daily: DataFrame, lats: DataFrame, key: str, value: str = "pan_in") -> DataFrame:
    """Hours of daily evaporation by ``day_share`` at each zone's latitude."""
    rows = upsample(daily.join(lats.select(key, F.col("lat").alias("_lat")), key), [key])
    return rows.withColumn(value, F.col(value) * day_share(F.col("time"), F.col("_lat"))).drop("_lat")


def end_labelled(df: DataFrame, period_hours: int, step_hours: int = 0, time: str = "time") -> DataFrame:
    """Labels at the end of periods moved to their start, so that the other operators apply; fine rows move by their own step."""
    return df.withColumn(time, F.col(time) - hours(step_hours or period_hours))


def hybrid_end_labelled(coarse: DataFrame, fine: DataFrame, key: str, value: str, parameters: CascadeParameters | DataFrame = DEFAULT, seed: int = 0, offset_hours: int = 0) -> DataFrame:
    """Daily totals that end at their label: by the fine pattern of the hours up to it, by the cascade where these are dry."""
    made = hybrid(end_labelled(coarse, 24), end_labelled(fine, 24, 1), key, value, parameters, seed, offset_hours)
    return made.withColumn("time", F.col("time") + hours(1))


def cascade_end_labelled(daily: DataFrame, key: str, value: str, parameters: CascadeParameters | DataFrame | None = None, seed: int = 0) -> DataFrame:
    """Hours of daily totals that end at their label, by a cascade fitted to the daily series itself unless parameters are given.

    A day's hours end with its label's own; hours before the first label of a zone
    are left out, as a series has no rows there.
    """
    parameters = fitted(daily, key, value) if parameters is None else parameters
    made = to_hours(cascade(daily, key, value, parameters, seed), key, value).withColumn("time", F.col("time") - hours(23))
    first = daily.groupBy(key).agg(F.min("time").alias("_first"))
    return made.join(first, key).filter(F.col("time") >= F.col("_first")).select(key, "time", value)


def percent_to_tenths(df: DataFrame, value: str, keys: list[str], period_hours: int = 3, utc_offset: int = 0) -> DataFrame:
    """Cloud cover in percent, every few hours, to hourly tenths at local labels; the last value holds for its period."""
    moved = df.withColumns({value: F.col(value) / 10.0, "time": F.col("time") - hours(utc_offset)})
    return upsample(moved, keys, period_hours)


def run_problems(rectangles: DataFrame, key: str, box: BoundingBox, start: date, end: date, least_days: int = 32) -> DataFrame:
    """What keeps a run from starting, a row (key, problem) each: zones beyond the extent, an end before the start, too short a run."""
    beyond = rectangles.filter(~contained(box)).select(F.col(key).cast("string").alias("zone"), F.lit("outside the extent").alias("problem"))
    said = ["the end is before the start"] if end < start else [f"fewer than {least_days} days"] if (end - start).days < least_days else []
    return beyond.unionByName(rectangles.sparkSession.createDataFrame([("all", x) for x in said], "zone string, problem string"))
