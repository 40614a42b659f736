"""Moment scaling without an ordered window, cascades by class, and the fit to daily series."""

import random

import pytest
from pyspark.sql import functions as F

from isohyet.operators import cascade, legacy, olsson

KIND = "zone int, at long, v double"


def series(spark, values, zone=1, step=3600, start="2001-01-01"):
    rows = spark.createDataFrame([(zone, k * step, None if v is None else float(v)) for k, v in enumerate(values)], KIND)
    return rows.select("zone", (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("at").cast("decimal(18,6)"))).alias("time"), "v")


def test_moments_have_no_window_and_equal_plain_loops(spark):
    import numpy as np

    rng = random.Random(3)
    told = {z: [rng.choice((0, 0, 0, rng.random() * 5)) for _ in range(32 * n + extra)] for z, n, extra in ((1, 5, 7), (2, 3, 31), (3, 0, 20))}
    df = series(spark, told[1]).unionByName(series(spark, told[2], 2, start="2003-05-01")).unionByName(series(spark, told[3], 3))
    made = cascade.moment_scaling(df, "zone", "v", step_seconds=3600)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    got = {(r.zone, r.q): r.tau for r in made.collect()}
    want = {}
    for z, values in told.items():
        n = len(values) - len(values) % 32
        if not n:
            continue
        for q in cascade.ORDERS:
            m = [np.mean([sum(values[k : k + (1 << s)]) ** q for k in range(0, n, 1 << s)]) for s in range(6)]
            want[z, q] = -np.polyfit([np.log(2.0 ** (5 - s)) for s in range(6)], np.log(m), 1)[0]
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    with pytest.raises(ValueError, match="irregular"):
        cascade.moment_scaling(df.filter("NOT (zone = 1 AND hour(time) = 5)").filter("zone = 1"), "zone", "v")


def test_olsson_statistics_by_hand(spark):
    """Sixteen steps, boxes of two: (1,0) isolated; (2,2),(0,3) starting and ending; the rest dry."""
    df = series(spark, [1, 0, 0, 0, 2, 2, 0, 3, 0, 0, 0, 0, 0, 0, 0, 0], start="1970-01-01")
    got = {(r.position, r.above): r for r in olsson.statistics(df, "zone", "v", levels=1).collect()}
    assert set(got) == {("isolated", False), ("starting", False), ("ending", False)}
    assert (got["isolated", False].n, got["isolated", False].first, got["isolated", False].second) == (1, 1.0, 0.0)
    assert got["starting", False].shares == [0, 0, 0, 1, 0, 0, 0] and got["ending", False].second == 1.0


def test_cascade_recovers_known_chances(spark):
    """Days split by given chances show them again: boxes of the finest level are classed and counted."""
    told = [(1, p, above, 0.1 + 0.1 * k, 0.4 - 0.1 * k, [0, 0, 0, 5, 5, 0, 0]) for k, p in enumerate(olsson.POSITIONS) for above in (False, True)]
    stats = spark.createDataFrame(told, "zone int, position string, above boolean, first double, second double, shares array<long>")
    daily = series(spark, [(k * 7919) % 11 if k % 4 else 0 for k in range(4000)], step=86_400, start="1970-01-01")
    parts = olsson.cascade(daily, "zone", "v", stats, seed=5, levels=1)
    sums = {r.time: r.s for r in parts.groupBy("time").agg(F.sum("value").alias("s")).collect()}
    assert sums == {r.time: pytest.approx(r.v) for r in daily.collect() if r.v > 0}
    halves = parts.select("zone", (F.col("time") + F.make_dt_interval(F.lit(0), (F.col("idx") * 12).cast("int"))).alias("time"), F.col("value").alias("v"))
    got = {(r.position, r.above): r for r in olsson.statistics(halves, "zone", "v", levels=1, step_seconds=43_200).collect()}
    for zone, position, above, first, second, _ in told:
        if (position, above) in got and got[position, above].n > 300:
            r = got[position, above]
            assert r.first == pytest.approx(first, abs=0.07) and r.second == pytest.approx(second, abs=0.07)
            assert sum(r.shares[:2] + r.shares[6:]) == 0 and r.shares[3] > 0
    assert sum(r.n > 300 for r in got.values()) >= 4
    again = olsson.cascade(daily.repartition(7), "zone", "v", stats, seed=5, levels=1)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, parts.collect()))


def test_olsson_days_keep_their_totals(spark):
    fine = series(spark, [0, 0, 3, 1, 0, 2] * 60)
    daily = series(spark, [3, 0, 7.5, None, 1], step=86_400)
    made = cascade.disaggregate_precipitation(daily, fine, "zone", "v", "olsson")
    sums = {r.d.day: r.s for r in made.groupBy(F.to_date("time").alias("d")).agg(F.sum("v").alias("s")).collect()}
    assert {d: s for d, s in sums.items() if s > 0} == {1: pytest.approx(3), 3: pytest.approx(7.5), 5: pytest.approx(1)}
    assert olsson.statistics(fine.limit(0), "zone", "v", step_seconds=3600).count() == 0
    unseen = olsson.cascade(daily, "zone", "v", olsson.statistics(fine.limit(0), "zone", "v", step_seconds=3600))
    assert unseen.agg(F.sum("value")).first()[0] == pytest.approx(11.5)


def test_cascade_fitted_to_the_daily_series(spark):
    rng = random.Random(1)
    daily = series(spark, [rng.choice((0, 0, rng.expovariate(0.2))) for _ in range(32 * 8)], step=86_400)
    assert cascade.fitted(daily, "zone", "v").first().fitted
    made = legacy.cascade_end_labelled(daily, "zone", "v")
    ends = made.agg(F.min("time"), F.max("time")).first()
    first, last = daily.agg(F.min("time"), F.max("time")).first()
    assert ends[0] >= first and ends[1] <= last
    whole = daily.agg(F.sum("v")).first()[0] - daily.orderBy("time").first().v
    lost = made.filter(F.col("time") > first).agg(F.sum("v")).first()[0]
    assert lost == pytest.approx(whole, rel=1e-9)
