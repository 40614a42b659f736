"""Canonical columns, and the projection from each source's names and units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.functions.cols import missing
from isohyet.functions.thermo import kelvin_to_celsius, wind_speed

UNITS = {
    "temperature_c": "degC", "specific_humidity_kgkg": "kg/kg", "pressure_pa": "Pa", "wind_u_ms": "m/s", "wind_v_ms": "m/s", "wind_speed_ms": "m/s",
    "longwave_wm2": "W/m2", "shortwave_wm2": "W/m2", "precip_mm": "mm", "dewpoint_c": "degC", "cloud_cover": "1", "pet_mm": "mm",
}
# The variables of each gridded source and their canonical columns.
NLDAS = {"Tair": "temperature_c", "Qair": "specific_humidity_kgkg", "PSurf": "pressure_pa", "Wind_E": "wind_u_ms", "Wind_N": "wind_v_ms", "LWdown": "longwave_wm2", "SWdown": "shortwave_wm2", "Rainf": "precip_mm"}
AORC = {"TMP_2maboveground": "temperature_c", "SPFH_2maboveground": "specific_humidity_kgkg", "PRES_surface": "pressure_pa", "UGRD_10maboveground": "wind_u_ms", "VGRD_10maboveground": "wind_v_ms", "DLWRF_surface": "longwave_wm2", "DSWRF_surface": "shortwave_wm2", "APCP_surface": "precip_mm"}
PRISM = {"ppt": "precip_mm", "tmax": "temperature_max_c", "tmin": "temperature_min_c", "tmean": "temperature_c", "tdmean": "dewpoint_c", "vpdmin": "vpd_min_hpa", "vpdmax": "vpd_max_hpa"}
NARR = {"air": "temperature_c", "uwnd": "wind_u_ms", "vwnd": "wind_v_ms", "apcp": "precip_mm", "dswrf": "shortwave_wm2", "dlwrf": "longwave_wm2", "tcdc": "cloud_cover", "pevap": "pet_mm", "snod": "snow_depth_m", "weasd": "snow_water_mm"}
MRMS = {"precip_mm": "precip_mm"}
SOURCES = {"nldas": NLDAS, "aorc": AORC, "prism": PRISM, "narr": NARR, "mrms": MRMS}
KELVIN_IN = {("nldas", "Tair"), ("aorc", "TMP_2maboveground"), ("narr", "air")}
PERCENT_IN = {("narr", "tcdc")}
RESOLUTION = {"nldas": 0.125, "prism_4km": 1 / 24, "prism_800m": 1 / 120, "mrms": 0.01, "aorc": 1 / 120}


def available(df: DataFrame, source: str) -> tuple[list[str], list[str]]:
    """Variables of the source that df has, and those it lacks."""
    have = [v for v in SOURCES[source] if v in df.columns]
    return have, [v for v in SOURCES[source] if v not in df.columns]


def canonical(df: DataFrame, source: str, keep: tuple[str, ...] = ("time", "lat", "lon")) -> DataFrame:
    """Rename, cast, convert units, NaN to NULL; units go to the columns' metadata."""
    if source not in SOURCES:
        raise ValueError(f"source must be one of {', '.join(SOURCES)}")

    def made(name: str) -> Column:
        x = missing(F.col(name).cast("double"))
        if (source, name) in KELVIN_IN:
            x = kelvin_to_celsius(x)
        if (source, name) in PERCENT_IN:
            x = x / 100
        to = SOURCES[source][name]
        return x.alias(to, metadata={"units": UNITS.get(to, "")})

    have, _ = available(df, source)
    out = df.select(*keep, *[made(v) for v in have])
    if {"wind_u_ms", "wind_v_ms"} <= set(out.columns):
        out = out.withColumn("wind_speed_ms", wind_speed("wind_u_ms", "wind_v_ms"))
    return out.withColumn("time", F.col("time") - F.expr("INTERVAL '12' HOUR")) if source == "prism" else out


def fetch_daymet(*_: object) -> DataFrame:
    raise NotImplementedError("daymet has no reader")
