import math

import pytest
from pyspark.sql import functions as F

from isohyet.functions import cols, evaporation, radiation, thermo


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_missing_and_clip_keep_null(spark):
    assert one(spark, cols.clip("a", 0.0), a=None) is None
    assert one(spark, cols.clip("a", 0.0, 1.0), a=3.0) == 1.0
    assert one(spark, cols.missing("a"), a=float("nan")) is None
    assert one(spark, cols.ratio("a", 0.0), a=1.0) is None


def test_humidity_round_trip(spark):
    e = one(spark, thermo.vapor_pressure_magnus("t", b=237.7, base=0.6112), t=12.5)
    assert one(spark, thermo.dewpoint_magnus("e"), e=e) == pytest.approx(12.5)
    assert one(spark, thermo.relative_humidity("t", "d", "p"), t=10.0, d=10.0, p=1e5) == pytest.approx(100, abs=1)
    assert one(spark, thermo.dewpoint_from_specific_humidity("q", "p"), q=0.0075, p=1e5) == pytest.approx(9.6, abs=0.6)


def test_wind(spark):
    assert one(spark, thermo.wind_speed("u", "v"), u=3.0, v=4.0) == 5.0
    assert one(spark, thermo.adjust_wind_height("u"), u=1.0) == pytest.approx(0.748, abs=1e-3)
    with pytest.raises(ValueError):
        thermo.adjust_wind_height("u", method="other")


def test_extra_radiation_fao_example(spark):
    got = spark.sql("SELECT TIMESTAMP_NTZ'2001-09-03' AS d").select(radiation.extra_radiation(F.col("d"), -20.0).alias("x")).first()["x"]
    assert got == pytest.approx(32.2, abs=0.1)


@pytest.mark.parametrize(
    ("at", "lat", "lon", "want"),
    [
        # a published worked example of the sun's position: 39.8884 degrees under its pressure; here standard refraction
        ("2003-10-17 19:30:30", 39.742476, -105.1786, 39.888),
        # the solstices at the tropics' noon, and the poles
        ("2020-06-20 21:43:40", 23.43, -145.5, 89.9),
        ("2020-12-21 10:02:00", 90.0, 0.0, -23.44),
        ("2020-06-20 21:43:40", 90.0, 0.0, 23.47),
    ],
)
def test_solar_elevation_by_known_positions(spark, at, lat, lon, want):
    got = spark.sql(f"SELECT TIMESTAMP_NTZ'{at}' AS t").select(radiation.solar_elevation(F.col("t"), lat, lon).alias("x")).first().x
    assert got == pytest.approx(want, abs=0.12 if want > 80 else 0.02)


def test_solar_elevation_at_equinox_noon(spark):
    got = spark.sql("SELECT TIMESTAMP_NTZ'2001-03-20 12:07:00' AS t").select(radiation.solar_elevation(F.col("t"), 0.0, 0.0).alias("x")).first()["x"]
    assert got == pytest.approx(90, abs=0.6)


def test_evaporation(spark):
    assert one(spark, evaporation.penman_knb("t", "d", "u", "s"), t=20.0, d=10.0, u=2.0, s=20.0) > 3
    with pytest.raises(NotImplementedError):
        evaporation.penman_pan()


def test_clearsky_is_dark_below_horizon(spark):
    got = spark.sql("SELECT TIMESTAMP_NTZ'2001-06-01' AS d, CAST(-5 AS DOUBLE) AS e").select(radiation.clearsky_ineichen("e", F.col("d")).alias("x")).first()["x"]
    assert got == 0.0
    assert math.isclose(radiation.SIGMA, 5.67e-8)
