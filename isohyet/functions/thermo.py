"""Temperature, wind and humidity."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from isohyet.functions.cols import Number, clip, col, ratio

# Physical constants of the formulas below.
KELVIN = 273.15
EPSILON = 0.622
TETENS = {"a": 17.27, "b": 237.3, "base": 0.6108}
MAGNUS = {"a": 17.27, "b": 237.7, "base": 0.6112}


def kelvin_to_celsius(k: Number) -> Column:
    return col(k) - KELVIN


def kelvin_to_fahrenheit(k: Number) -> Column:
    return kelvin_to_celsius(k) * 9 / 5 + 32


def celsius_to_fahrenheit(c: Number) -> Column:
    return col(c) * 9 / 5 + 32


def wind_speed(u: Number, v: Number) -> Column:
    return F.sqrt(col(u) * col(u) + col(v) * col(v))


def adjust_wind_height(u: Number, z_from: float = 10.0, z_to: float = 2.0, method: str = "log", alpha: float = 1 / 7) -> Column:
    if method == "log":
        return col(u) * (math.log(67.8 * z_to - 5.42) / math.log(67.8 * z_from - 5.42))
    if method == "power_law":
        return col(u) * (z_to / z_from) ** alpha
    raise ValueError(f"method must be log or power_law, not {method!r}")


def wind_function_kohler(u: Number) -> Column:
    return 0.005 + 0.00085 * 3.6 * col(u)


def wind_function_fao56(u: Number, temperature_c: Number, cn: float = 37.0) -> Column:
    return ratio(cn, col(temperature_c) + 273) * col(u)


def latent_heat_linear(temperature_c: Number) -> Column:
    return 2.501 - 0.002361 * col(temperature_c)


def psychrometric_constant_dynamic(pressure_kpa: Number, latent_heat: Number) -> Column:
    return ratio(0.00163 * col(pressure_kpa), latent_heat)


def vapor_pressure_magnus(temperature_c: Number, a: float = 17.27, b: float = 237.3, base: float = 0.6108) -> Column:
    t = col(temperature_c)
    return base * F.exp(ratio(a * t, t + b))


def delta_svp(temperature_c: Number, b: float = 237.3) -> Column:
    t = col(temperature_c)
    return ratio(17.27 * b * vapor_pressure_magnus(t, b=b), (t + b) * (t + b))


def vapor_pressure_lamoreux(temperature_f: Number) -> Column:
    """Inches of mercury."""
    return 6413252.0 * F.exp(ratio(-7482.6, col(temperature_f) + 398.36))


def vapor_pressure_mixing(q: Number, pressure_pa: Number) -> Column:
    w = ratio(q, 1 - col(q))
    return ratio(w, EPSILON + w) * col(pressure_pa) / 1000


def dewpoint_magnus(e: Number, a: float = 17.27, b: float = 237.7, base: float = 0.6112) -> Column:
    level = F.log(col(e) / base)
    return ratio(b * level, a - level)


def dewpoint_cc(e: Number, ref: float = 0.6113, c: float = 0.0001844) -> Column:
    return ratio(1.0, 1 / KELVIN - c * F.log(col(e) / ref)) - KELVIN


def specific_humidity(dewpoint_c: Number, pressure_pa: Number) -> Column:
    e = vapor_pressure_magnus(dewpoint_c)
    return ratio(EPSILON * e, col(pressure_pa) / 1000 - 0.378 * e)


def relative_humidity_from_specific_humidity(temperature_c: Number, q: Number, pressure_pa: Number) -> Column:
    e = ratio(col(q) * (col(pressure_pa) / 1000), EPSILON + col(q))
    return clip(100 * ratio(e, vapor_pressure_magnus(temperature_c)), 0, 100)


def relative_humidity(temperature_c: Number, dewpoint_c: Number, pressure_pa: Number) -> Column:
    return relative_humidity_from_specific_humidity(temperature_c, specific_humidity(dewpoint_c, pressure_pa), pressure_pa)


def dewpoint_from_specific_humidity(q: Number, pressure_pa: Number = 101325.0) -> Column:
    """Bolton's inversion, an approximation: 243.5 L / (17.67 - L) with L = ln(e / 6.112 hPa)."""
    level = F.log(vapor_pressure_mixing(q, pressure_pa) * 10 / 6.112)
    return ratio(243.5 * level, 17.67 - level)


def dewpoint_from_specific_humidity_cc(q: Number, pressure_pa: Number) -> Column:
    return dewpoint_cc(vapor_pressure_mixing(q, pressure_pa))


def dewpoint_august_roche_magnus(q: Number, pressure_pa: Number) -> Column:
    return dewpoint_magnus(vapor_pressure_mixing(q, pressure_pa))
