"""Radiation, solar geometry and cloud."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from isohyet.functions.cols import Number, acos, clip, col, ratio
from isohyet.functions.thermo import KELVIN, vapor_pressure_magnus

SIGMA = 5.67e-8
SOLAR_CONSTANT = 1361.0
GSC_DAY = 118.08
GSC_HWW = 117.5


def net_radiation(sw: Number, lw: Number, temperature_c: Number, albedo: float = 0.23, emissivity: float = 0.97) -> Column:
    return col(sw) * (1 - albedo) + col(lw) - emissivity * SIGMA * F.pow(col(temperature_c) + KELVIN, 4)


def clearsky_geometric(time: Column, lat: Number) -> Column:
    """Clock hours count as solar hours."""
    decl = F.radians(23.45 * F.sin(F.radians(360 / 365 * (284 + F.dayofyear(time)).cast("double"))))
    phi = F.radians(col(lat))
    cosz = F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.cos(F.radians(15.0 * (F.hour(time) - 12)))
    return SOLAR_CONSTANT * clip(cosz, 0.0) * 0.75


def extra_radiation(day: Column, lat: Number) -> Column:
    """Daily radiation above the atmosphere, MJ per m2 and day."""
    theta = 2 * math.pi / 365 * F.dayofyear(day).cast("double")
    phi, dr, decl = F.radians(col(lat)), 1 + 0.033 * F.cos(theta), 0.409 * F.sin(theta - 1.39)
    sunset = acos(-F.tan(phi) * F.tan(decl))
    return GSC_DAY / math.pi * dr * (sunset * F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.sin(sunset))


def clearsky_hww(day: Column, lat: Number) -> Column:
    """Spencer's series for declination and distance; 0.73 of the daily radiation above the atmosphere."""
    g = 2 * math.pi * (F.dayofyear(day) - 1).cast("double") / 365
    decl = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    dr = 1.00011 + 0.034221 * F.cos(g) + 0.00128 * F.sin(g) + 0.000719 * F.cos(2 * g) + 0.000077 * F.sin(2 * g)
    phi = F.radians(col(lat))
    sunset = acos(-F.tan(phi) * F.tan(decl))
    return 0.73 * (GSC_HWW / math.pi * dr * (sunset * F.sin(phi) * F.sin(decl) + F.cos(phi) * F.cos(decl) * F.sin(sunset)))


def clearsky_fao56(extra: Number, elevation_m: Number) -> Column:
    return (0.75 + 2e-5 * col(elevation_m)) * col(extra)


def solar_elevation(time: Column, lat: Number, lon: Number) -> Column:
    """Apparent elevation in degrees at an instant (UTC), by the almanac's low-precision sun and standard refraction; good to 0.02 degrees from 1950 to 2050."""
    hour = F.hour(time) + F.minute(time) / 60.0 + F.second(time) / 3600.0
    days = F.unix_date(F.to_date(time)) + hour / 24.0 - 10957.5  # since noon of the first day of 2000
    g = F.radians(357.528 + 0.9856003 * days)
    ecliptic = F.radians(280.460 + 0.9856474 * days + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    tilt = F.radians(23.439 - 0.0000004 * days)
    turned = F.radians(280.46061837 + 15.0 * hour - 180.0 + 0.98564736629 * days + col(lon))
    phi = F.radians(col(lat))
    # the sun's direction in the equator's frame, turned to the meridian of the place
    height = F.sin(phi) * F.sin(tilt) * F.sin(ecliptic) + F.cos(phi) * (F.cos(turned) * F.cos(ecliptic) + F.sin(turned) * F.cos(tilt) * F.sin(ecliptic))
    true = F.degrees(F.asin(clip(height, -1.0, 1.0)))
    return true + F.when(true > -1.0, 1.02 / F.tan(F.radians(true + 10.3 / (true + 5.11))) / 60).otherwise(0.0)


def is_daytime(elevation_deg: Number, least: float = 10.0) -> Column:
    """Whether the sun stands at least so high."""
    return col(elevation_deg) >= least


def extra_radiation_hourly(time: Column, elevation_deg: Number) -> Column:
    """Radiation above the atmosphere on a level plane at an instant, W per m2 (Spencer's distance, 1366.1 W per m2)."""
    g = 2 * math.pi / 365 * (F.dayofyear(time) - 1).cast("double")
    distance = 1.00011 + 0.034221 * F.cos(g) + 0.00128 * F.sin(g) + 0.000719 * F.cos(2 * g) + 0.000077 * F.sin(2 * g)
    return 1366.1 * distance * clip(F.sin(F.radians(col(elevation_deg))), 0.0)


#: Where no climatology tells the turbidity.
CLEAR_TURBIDITY = 3.0
#: Middles of the months as days of a year of 365 days.
MONTH_MIDDLES = (16.0, 45.0, 74.5, 105.0, 135.5, 166.0, 196.5, 227.5, 258.0, 288.5, 319.0, 349.5)


def monthly_at(day: Column, monthly: Column) -> Column:
    """The value at a day of the year between the middles of two months, from an array of twelve; the year is a ring."""
    day = day.cast("double")
    before = sum((F.when(day >= m, 1).otherwise(0) for m in MONTH_MIDDLES), F.lit(0))
    middles = F.array(*[F.lit(x) for x in (MONTH_MIDDLES[-1] - 365.0, *MONTH_MIDDLES, MONTH_MIDDLES[0] + 365.0)])
    values = F.concat(F.slice(monthly, 12, 1), monthly, F.slice(monthly, 1, 1))
    x0, x1, v0, v1 = F.get(middles, before), F.get(middles, before + 1), F.get(values, before), F.get(values, before + 1)
    return v0 + (v1 - v0) * (day - x0) / (x1 - x0)


def clearsky_ineichen(elevation_deg: Number, day: Column, turbidity: Number = CLEAR_TURBIDITY, altitude_m: Number = 0.0) -> Column:
    """The published Ineichen and Perez global irradiance; turbidity and altitude may be columns."""
    high, haze = col(altitude_m), col(turbidity)
    fh1, fh2 = F.exp(-high / 8000), F.exp(-high / 1250)
    cg1, cg2 = 5.09e-5 * high + 0.868, 3.92e-5 * high + 0.0387
    up = clip(F.sin(F.radians(col(elevation_deg))), 0.0)
    mass = ratio(1.0, up + 0.50572 * F.pow(clip(col(elevation_deg), 0.0) + 6.07995, -1.6364))
    outside = 1367.0 * (1 + 0.033 * F.cos(2 * math.pi / 365 * F.dayofyear(day).cast("double")))
    made = cg1 * outside * up * F.exp(-cg2 * mass * (fh1 + fh2 * (haze - 1))) * F.exp(0.01 * F.pow(mass, 1.8))
    return F.when(col(elevation_deg) > 0, made).when(col(elevation_deg).isNotNull(), 0.0)


def cloud_cover_davis(sw: Number, clearsky: Number, elevation_deg: Number, k: float = 0.65, least: float = 10.0) -> Column:
    kt = clip(ratio(sw, clearsky), 0.0, 1.0)
    return F.when(col(elevation_deg) >= least, clip(F.sqrt((1 - kt) / k), 0.0, 1.0))


def cloud_cover_thompson(sw: Number, clearsky: Number, elevation_deg: Number, least: float = 10.0, coefficients: tuple[float, float, float] = (0.0, 1.0, 0.0)) -> Column:
    a, b, c = coefficients
    kt = ratio(sw, clearsky)
    return F.when(col(elevation_deg) >= least, clip(a + b * kt + c * kt * kt, 0.0, 1.0))


def cloud_cover_linear(sw: Number, clearsky: Number, elevation_deg: Number, least: float = 10.0) -> Column:
    return F.when(col(elevation_deg) >= least, clip(1 - ratio(sw, clearsky), 0.0, 1.0))


def sky_cover_thompson(clearsky: Number, cover: Number, b: float = 0.3) -> Column:
    return col(clearsky) * (b + (1 - b) * F.pow(1 - clip(cover, 0.0, 1.0), 0.61))


def actual_radiation_hww(clearsky: Number, percent: Number, a: float = 0.22, b: float = 0.78) -> Column:
    return col(clearsky) * (a + b * clip(percent, 0.0, 100.0) / 100)


def net_longwave_direct(temperature_c: Number, lw: Number, emissivity: float = 0.98) -> Column:
    return emissivity * SIGMA * F.pow(col(temperature_c) + KELVIN, 4) - col(lw)


def net_longwave_brutsaert(temperature_c: Number, e_kpa: Number, emissivity: float = 0.98) -> Column:
    t = col(temperature_c) + KELVIN
    air = 1.24 * F.pow(10 * clip(e_kpa, 0.0) / t, 1 / 7)
    return emissivity * SIGMA * F.pow(t, 4) - air * SIGMA * F.pow(t, 4)


def net_longwave_brunt(temperature_c: Number, e_kpa: Number, cloud_factor: Number = 1.0, a: float = 0.34, b: float = 0.14) -> Column:
    return SIGMA * F.pow(col(temperature_c) + KELVIN, 4) * (a - b * F.sqrt(col(e_kpa))) * col(cloud_factor)


def cloud_factor_from_ratio(r: Number) -> Column:
    return 1.35 * clip(r, 0.25, 1.0) - 0.35


def cloud_factor_fao56(sw: Number, clearsky: Number) -> Column:
    return cloud_factor_from_ratio(F.when(col(clearsky) > 0, ratio(sw, clearsky)).otherwise(1.0))


def net_radiation_arm(sw: Number, temperature_c: Number, dewpoint_c: Number, cloud_factor: Number = 1.0, albedo: float = 0.23, a: float = 0.34, b: float = 0.14) -> Column:
    e = vapor_pressure_magnus(dewpoint_c, b=237.7, base=0.6112)
    return col(sw) * (1 - albedo) - net_longwave_brunt(temperature_c, e, cloud_factor, a, b)
