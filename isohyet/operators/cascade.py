"""Random cascades of daily precipitation to hours, reproducible under any partitioning.

Each value splits in two, five times (45-minute steps), by log-Poisson weights
and wet or dry draws; the five draws of a split are 24 bits each of one hash of
(seed, key, day, level, place).  Thirds of the 45-minute steps then add up to
hours, so that a day keeps its total.

The parameters are either one set for all, or a table with a row per key, as
``fit_parameters`` makes it from the moment scaling of each key's fine series; keys
that the table lacks, and series that are all dry or too short to fit, take
``DEFAULT``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isohyet.operators import olsson
from isohyet.operators.disaggregate import conserve_sum, normalise, with_period
from isohyet.operators.time import epoch_seconds, hours, infer_step_seconds

LEVELS = 5
#: Scales of the moments, and values of a run that holds whole blocks of all of them.
SCALES = 6
RUN = 1 << (SCALES - 1)
ORDERS = tuple(0.5 * k for k in range(1, 11))


@dataclass(frozen=True)
class CascadeParameters:
    """amplitude A, base beta, and the exponent of the first moment order."""

    amplitude: float = 1.5
    beta: float = 0.4
    tau0: float = 0.3

#: Used where a series is all dry or too short to fit.
DEFAULT = CascadeParameters()


def poisson_one(u: Column) -> Column:
    """Inverse of the Poisson distribution of mean 1, up to 8."""
    made, total = F.lit(8), 0.0
    steps = []
    for k in range(8):
        total += math.exp(-1) / math.factorial(k)
        steps.append((k, total))
    for k, level in reversed(steps):
        made = F.when(u < level, k).otherwise(made)
    return made


def with_parameters(df: DataFrame, key: str, parameters: CascadeParameters | DataFrame) -> DataFrame:
    """df with _amplitude, _beta and _wet, the chance that a half is wet."""
    fixed = parameters if isinstance(parameters, CascadeParameters) else DEFAULT
    if isinstance(parameters, DataFrame):
        told = parameters.select(key, *[F.col(c).alias(f"_{c}") for c in ("amplitude", "beta", "tau0")])
        df = df.join(told, key, "left")
    else:
        df = df.withColumns({f"_{c}": F.lit(None).cast("double") for c in ("amplitude", "beta", "tau0")})
    df = df.withColumns({f"_{c}": F.coalesce(F.col(f"_{c}"), F.lit(getattr(fixed, c))) for c in ("amplitude", "beta", "tau0")})
    p = 1.0 - F.pow(F.lit(2.0), F.col("_tau0") - 1.0)
    return df.withColumn("_wet", 1.0 - F.least(F.greatest(p * (1.0 + p), F.lit(0.0)), F.lit(1.0))).drop("_tau0")


def _split(df: DataFrame, key: str, level: int, seed: Column) -> DataFrame:
    day = F.unix_seconds(F.col("time").cast("timestamp"))
    said = df.withColumn("_md5", F.md5(F.concat_ws("|", *[x.cast("string") for x in (seed, F.col(key), day, F.lit(level), F.col("idx"))])))
    u = lambda k: F.conv(F.substring("_md5", 6 * k + 1, 6), 16, 10).cast("double") / F.lit(16777216.0)
    drawn = said.select("*", *[u(k).alias(f"_u{k}") for k in range(5)])
    w = lambda k: F.col("_amplitude") * F.pow(F.col("_beta"), poisson_one(F.col(f"_u{k}")).cast("double"))
    wet0, wet1 = F.col("_u2") < F.col("_wet"), F.col("_u3") < F.col("_wet")
    none = ~wet0 & ~wet1
    first = F.when(wet0 | (none & (F.col("_u4") < 0.5)), w(0)).otherwise(0.0)
    second = F.when(wet1 | (none & (F.col("_u4") >= 0.5)), w(1)).otherwise(0.0)
    halves = drawn.select("*", first.alias("_w0"), second.alias("_w1"))
    share = F.when(F.col("_w0") + F.col("_w1") > 0, F.col("_w0") / (F.col("_w0") + F.col("_w1"))).otherwise(0.5)
    parts = halves.withColumn("_share", share)
    both = F.array(
        F.struct((F.col("idx") * 2).alias("idx"), (F.col("value") * F.col("_share")).alias("value")),
        F.struct((F.col("idx") * 2 + 1).alias("idx"), (F.col("value") * (1 - F.col("_share"))).alias("value")),
    )
    rest = [c for c in df.columns if c not in ("idx", "value")]
    return parts.select(*rest, F.explode(both).alias("_h")).select(*rest, "_h.idx", "_h.value")


def cascade(daily: DataFrame, key: str, value: str, parameters: CascadeParameters | DataFrame = DEFAULT, seed: int | Column = 0, levels: int = LEVELS) -> DataFrame:
    """key, time (day), idx, value of the 2**levels parts of each positive day."""
    wet = daily.filter(F.col(value) > 0).select(*[c for c in daily.columns if c != value], F.lit(0).cast("long").alias("idx"), F.col(value).alias("value"))
    now = with_parameters(wet, key, parameters)
    for level in range(levels):
        now = _split(now, key, level, seed if isinstance(seed, Column) else F.lit(seed))
    return now.drop("_amplitude", "_beta", "_wet")


def to_hours(parts: DataFrame, key: str, value: str) -> DataFrame:
    """45-minute parts to hours: a part's three quarters of an hour each carry a third."""
    rest = [c for c in parts.columns if c not in ("idx", "value", "time")]
    quarters = parts.select(*rest, "time", F.explode(F.sequence(F.col("idx") * 3, F.col("idx") * 3 + 2)).alias("_q"), (F.col("value") / 3.0).alias("_v"))
    hour = F.col("time") + hours(F.floor(F.col("_q") / 4).cast("int"))
    return quarters.groupBy(*rest, F.col("time").alias("_period"), hour.alias("time")).agg(F.sum("_v").alias(value))


def moment_scaling(series: DataFrame, key: str, value: str, time: str = "time", step_seconds: int | None = None) -> DataFrame:
    """key, q, tau: minus the slope of log mean moments against log scale, over six dyadic scales.

    A row's place follows from its label and the step of the series (inferred
    unless given), so nothing is ordered.  Runs of 32 neighbours are dealt out once;
    in that dealing each scale adds up pairs of the one before it, without another
    shuffle.  Values that are missing count as 0; the rest beyond whole runs is left out.
    """
    step = step_seconds or infer_step_seconds(series, time)
    ends = series.groupBy(key).agg(F.min(epoch_seconds(time)).alias("_a"), F.max(epoch_seconds(time)).alias("_b"))
    place, runs = ((epoch_seconds(time) - F.col("_a")) / step).cast("long"), F.floor(((F.col("_b") - F.col("_a")) / step + 1) / RUN)
    placed = series.join(ends, key).select(key, F.floor(place / RUN).alias("_run"), (place % RUN).cast("int").alias("_at"), F.coalesce(value, F.lit(0.0)).alias("_v"), runs.alias("_runs"))
    now = placed.filter("_run < _runs").drop("_runs").repartition(key, "_run")
    scales = []
    for s in range(SCALES):
        if s:
            now = now.groupBy(key, "_run", F.shiftright("_at", 1).alias("_at")).agg(F.sum("_v").alias("_v"))
        scales.append(now.select(key, F.lit(s).alias("s"), "_v"))
    told = scales[0]
    for more in scales[1:]:
        told = told.unionByName(more)
    wide = told.groupBy(key, "s").agg(*[F.avg(F.pow("_v", F.lit(q))).alias(f"{q}") for q in ORDERS])
    moments = wide.unpivot([key, "s"], [f"`{q}`" for q in ORDERS], "q", "m").withColumn("q", F.col("q").cast("double"))
    return moments.filter("m > 0").groupBy(key, "q").agg((-F.regr_slope(F.log("m"), F.log(F.pow(F.lit(2.0), SCALES - 1 - F.col("s"))))).alias("tau"))


def nelder_mead(f, start: list[float], steps: int = 400, tolerance: float = 1e-9) -> np.ndarray:
    """Minimum of a function of a few numbers by the downhill simplex."""
    n = len(start)
    points = [np.array(start, float)]
    for k in range(n):
        p = np.array(start, float)
        p[k] = p[k] * 1.05 if p[k] else 0.00025
        points.append(p)
    values = [f(p) for p in points]
    for _ in range(steps):
        order = np.argsort(values, kind="stable")
        points, values = [points[k] for k in order], [values[k] for k in order]
        if abs(values[-1] - values[0]) < tolerance and max(np.abs(p - points[0]).max() for p in points) < tolerance:
            break
        centre = np.mean(points[:-1], axis=0)
        tried = {m: centre + m * (centre - points[-1]) for m in (1.0, 2.0, 0.5, -0.5)}
        if (v := f(tried[1.0])) < values[0]:
            w = f(tried[2.0])
            points[-1], values[-1] = (tried[2.0], w) if w < v else (tried[1.0], v)
        elif v < values[-2]:
            points[-1], values[-1] = tried[1.0], v
        else:
            m = 0.5 if v < values[-1] else -0.5
            if (w := f(tried[m])) < min(v, values[-1]):
                points[-1], values[-1] = tried[m], w
            else:
                points = [points[0], *[points[0] + 0.5 * (p - points[0]) for p in points[1:]]]
                values = [f(p) for p in points]
    return points[int(np.argmin(values))]


def fit_parameters(moments: DataFrame, key: str) -> DataFrame:
    """key, amplitude, beta, tau0, fitted; the defaults for series without all ten exponents."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.dropna().sort_values("q")
        name = frame[key].iloc[0] if len(frame) else None
        if len(frame) < len(ORDERS):
            return pd.DataFrame([(name, DEFAULT.amplitude, DEFAULT.beta, DEFAULT.tau0, False)], columns=[key, "amplitude", "beta", "tau0", "fitted"])
        q, tau = frame["q"].to_numpy(), frame["tau"].to_numpy()

        def loss(x: np.ndarray) -> float:
            c, beta = abs(x)
            return float(np.sqrt(np.mean((q - c * (q * (1 - beta) + beta**q - 1) / np.log(2) - tau) ** 2)))

        c, beta = abs(nelder_mead(loss, [0.4, 0.2]))
        return pd.DataFrame([(name, float(np.exp(c * (1 - beta))), float(beta), float(tau[0]), True)], columns=[key, "amplitude", "beta", "tau0", "fitted"])

    return moments.groupBy(key).applyInPandas(fit, f"{key} {dict(moments.dtypes)[key]}, amplitude double, beta double, tau0 double, fitted boolean")


def hybrid(coarse: DataFrame, fine: DataFrame, key: str, value: str, parameters: CascadeParameters | DataFrame = DEFAULT, seed: int | Column = 0, offset_hours: int = 0, enforce_coarse_mass: bool = True, more: tuple[str, ...] = ()) -> DataFrame:
    """Per period: by the fine pattern where it has rain, else by the cascade; dry coarse periods stay dry or keep the pattern.

    Only periods that need it go through the cascade.  ``more`` names further
    key columns that both sides carry (realisations).
    """
    keys = [key, *more]
    weighted = normalise(fine.withColumn("_fine", F.coalesce(F.col(value), F.lit(0.0))), keys, F.col("_fine"), "_w", offset_hours)
    placed = with_period(weighted, offset_hours)
    totals = placed.groupBy(*keys, "_period").agg(F.sum("_fine").alias("_sum"))
    told = totals.join(coarse.select(*keys, F.col("time").alias("_period"), F.col(value).alias("_coarse")), [*keys, "_period"], "left")
    need = told.filter("_coarse > 0 and _sum <= 0").select(*keys, F.col("_period").alias("time"), F.col("_coarse").alias(value))
    drawn = to_hours(cascade(need, key, value, parameters, seed), key, "_cascade").drop("_period")
    met = placed.join(told, [*keys, "_period"]).join(drawn, [*keys, "time"], "left")
    dry = F.lit(0.0) if enforce_coarse_mass else F.col("_fine")
    made = F.when((F.col("_coarse") > 0) & (F.col("_sum") > 0), F.col("_coarse") * F.col("_w")).when(F.col("_coarse") > 0, F.coalesce("_cascade", F.lit(0.0))).when((F.col("_coarse") <= 0) & (F.col("_sum") > 0), dry).otherwise(0.0)
    return met.withColumn(value, made).drop("_w", "_fine", "_sum", "_coarse", "_cascade", "_period")


def fitted(fine: DataFrame, key: str, value: str) -> DataFrame:
    """Cascade parameters of each key, fitted to its fine series."""
    return fit_parameters(moment_scaling(fine.withColumn(value, F.coalesce(F.col(value), F.lit(0.0))), key, value), key)


def disaggregate_precipitation(coarse: DataFrame, fine: DataFrame, key: str, value: str, method: str = "hybrid", parameters: CascadeParameters | DataFrame | None = None, seed: int = 0, offset_hours: int = 0) -> DataFrame:
    """method: proportional, molnar_burlando, olsson or hybrid; parameters, or Olsson's statistics, are taken from fine unless given."""
    if method not in ("proportional", "molnar_burlando", "olsson", "hybrid"):
        raise ValueError("method must be proportional, molnar_burlando, olsson or hybrid")
    if method == "proportional":
        weights = normalise(fine, [key], F.col(value), offset_hours=offset_hours).drop(value)
        return conserve_sum(coarse, weights, [key], value, offset_hours=offset_hours)
    if method == "olsson":
        told = olsson.statistics(fine, key, value) if parameters is None else parameters
        parts = olsson.cascade(coarse.select(key, "time", value), key, value, told, seed)
    else:
        parameters = fitted(fine, key, value) if parameters is None else parameters
        if method == "hybrid":
            return hybrid(coarse, fine, key, value, parameters, seed, offset_hours)
        parts = cascade(coarse.select(key, "time", value), key, value, parameters, seed)
    drawn = to_hours(parts, key, value).drop("_period")
    return fine.select(key, "time").join(drawn, [key, "time"], "left").na.fill({value: 0.0})


def monte_carlo(coarse: DataFrame, fine: DataFrame, key: str, value: str, realizations: int = 500, wet_threshold: float = 0.1, parameters: CascadeParameters | DataFrame = DEFAULT, offset_hours: int = 0) -> tuple[DataFrame, DataFrame]:
    """Hourly ensemble statistics, and daily peak and wet-hour statistics, of cascade days.

    Each realisation has a seed of its own; realisations come by exploding a
    sequence beside the days that go through the cascade.
    """
    placed = with_period(fine, offset_hours).groupBy(key, "_period").agg(F.sum(F.coalesce(F.col(value), F.lit(0.0))).alias("_sum"), F.max(F.col(value).isNull().cast("int")).alias("_gap"))
    days = coarse.join(placed.withColumnRenamed("_period", "time"), [key, "time"]).filter((F.col(value) > 0) & (F.col("_sum") == 0) & (F.col("_gap") == 0)).select(key, "time", value)
    many = days.withColumn("realization", F.explode(F.sequence(F.lit(1), F.lit(realizations))))
    drawn = to_hours(cascade(many, key, value, parameters, F.col("realization")), key, value)
    slots = many.select(key, "realization", F.col("time").alias("_period"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).withColumn("time", F.col("_period") + hours(F.col("hour")))
    full = slots.join(drawn, [key, "realization", "_period", "time"], "left").withColumn("_v", F.coalesce(F.col(value), F.lit(0.0)))
    points = F.percentile("_v", F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)]))
    mean = F.avg("_v")
    hourly = full.groupBy(key, F.col("_period").alias("day"), "hour").agg(mean.alias("mean"), F.stddev_pop("_v").alias("std"), F.when(mean > 0, F.stddev_pop("_v") / mean).alias("cv"), points.alias("_q"))
    hourly = hourly.select(key, "day", "hour", "mean", "std", "cv", *[F.get("_q", F.lit(k)).alias(n) for k, n in enumerate(("q05", "q25", "q50", "q75", "q95"))])
    # Hours whose rain differs by rounding alone tie; the first of them is the peak.
    even = F.round("_v", 9)
    runs = full.groupBy(key, F.col("_period").alias("day"), "realization").agg(
        F.max("_v").alias("peak"), F.max_by("hour", F.struct(even, -F.col("hour"))).alias("peak_hour"), F.sum((even >= wet_threshold).cast("int")).alias("wet_hours")
    )
    daily = runs.groupBy(key, "day").agg(*[made.alias(f"{name}_{kind}") for name in ("peak", "peak_hour", "wet_hours") for kind, made in (("mean", F.avg(name)), ("std", F.stddev_pop(name)))])
    return hourly, daily
