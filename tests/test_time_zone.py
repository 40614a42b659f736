"""The driver's and the session's time zones move no label."""

import os
import time

import pytest

from isohyet.operators.time import complete, spine


@pytest.mark.parametrize("driver", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("session", ["UTC", "America/Chicago"])
def test_spine_under_zones(spark, monkeypatch, driver, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    monkeypatch.setenv("TZ", driver)
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        # the night in which clocks jump, where a zoned hour would be lost
        df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-03-10 00:00:00', 1e0), (1, TIMESTAMP_NTZ'2024-03-10 04:00:00', 2e0) AS t(zone, time, x)")
        made = [r["t"] for r in spine(df, ["zone"]).selectExpr("CAST(time AS STRING) AS t").orderBy("t").collect()]
        assert made == [f"2024-03-10 0{h}:00:00" for h in range(5)]
        full = complete(df, ["zone"], {"x": 0.0}).selectExpr("CAST(time AS STRING) AS t", "x").orderBy("t").collect()
        assert [r["x"] for r in full] == [1.0, 0.0, 0.0, 0.0, 2.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        os.environ.pop("TZ", None)
        monkeypatch.undo()
        time.tzset()
