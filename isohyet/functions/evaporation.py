"""Potential evapotranspiration, mm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isohyet.functions.cols import Number, clip, col, ratio
from isohyet.functions.radiation import extra_radiation, net_radiation
from isohyet.functions.thermo import celsius_to_fahrenheit, delta_svp, vapor_pressure_lamoreux, vapor_pressure_magnus


def hargreaves(day: Column, tmin: Number, tmax: Number, lat: Number) -> Column:
    low, high = col(tmin), col(tmax)
    made = 0.0023 * (extra_radiation(day, lat) / 2.45) * ((low + high) / 2 + 17.8) * F.sqrt(clip(high - low, 0.0))
    return clip(F.coalesce(made, F.lit(0.0)), 0.0)


def penman_pan(*_: Number) -> Column:
    raise NotImplementedError("penman_pan has no definition")


def priestley_taylor(*_: Number) -> Column:
    raise NotImplementedError("priestley_taylor has no definition")


def penman_knb(tmean: Number, tdew: Number, wind_ms: Number, solar_mj: Number) -> Column:
    t, dew = celsius_to_fahrenheit(tmean), celsius_to_fahrenheit(tdew)
    solar = clip(col(solar_mj) * 23.8845, 25.0)
    radiant = F.exp((t - 212) * (0.1024 - 0.01066 * F.log(solar))) - 0.0001
    deficit = clip(vapor_pressure_lamoreux(t) - vapor_pressure_lamoreux(dew), 0.0)
    moved = 0.0105 * F.pow(deficit, 0.88) * (0.37 + 0.0041 * (col(wind_ms) * 53.6819))
    slope = 4.79878e10 * F.exp(ratio(-7482.6, t + 398.36)) / ((t + 398.36) * (t + 398.36))
    return clip(ratio(radiant + moved, slope + 0.0105) * 25.4, 0.0)


def oudin(day: Column, temperature_c: Number, lat: Number) -> Column:
    return clip(extra_radiation(day, lat) / 2.45 / 100 * (col(temperature_c) + 5), 0.0)


def penman_monteith_asce(sw: Number, lw: Number, temperature_c: Number, dewpoint_c: Number, wind_ms: Number, pressure_pa: Number, albedo: float = 0.23, cn: float = 37.0, cd_day: float = 0.24, cd_night: float = 0.96) -> Column:
    rn = net_radiation(sw, lw, temperature_c, albedo) * 0.0036
    day = rn > 0
    ground = F.when(day, 0.1 * rn).otherwise(0.5 * rn)
    cd = F.when(day, cd_day).otherwise(cd_night)
    gamma = 0.000665 * (col(pressure_pa) / 1000)
    slope = delta_svp(temperature_c)
    deficit = clip(vapor_pressure_magnus(temperature_c) - vapor_pressure_magnus(dewpoint_c), 0.0)
    top = 0.408 * slope * (rn - ground) + ratio(gamma * cn, col(temperature_c) + 273.15) * col(wind_ms) * deficit
    return clip(ratio(top, slope + gamma * (1 + cd * col(wind_ms))), 0.0)
