"""Keyed streaming state: micro-batches in any cut equal the batch operators; restarts go on where they stopped."""

import pytest
from pyspark.sql import functions as F

from isohyet.operators.time import asof
from isohyet.streaming import stateful

FINE = "SELECT z AS zone, explode(sequence(TIMESTAMP'2001-01-01', TIMESTAMP'2001-01-05', INTERVAL 6 HOUR)) AS time FROM VALUES (1), (2), (3) AS t(z)"
COARSE = "SELECT * FROM VALUES (1, TIMESTAMP'2000-12-31 10:00:00', 5e0), (1, TIMESTAMP'2001-01-02 03:00:00', 6e0), (1, TIMESTAMP'2001-01-03', NULL), (2, TIMESTAMP'2001-01-04', 7e0) AS t(zone, time, v)"
END = "SELECT 99 AS zone, TIMESTAMP'2002-01-01' AS time"


@pytest.fixture(autouse=True)
def state_store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.configure(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def run(stream, tmp_path):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return query


def test_fill_equals_the_batch_operator_over_restarts(spark, tmp_path):
    fine, coarse = spark.sql(FINE), spark.sql(COARSE)
    a, b = str(tmp_path / "fine"), str(tmp_path / "coarse")
    want = {(r.zone, r.time): r.v for r in asof(fine, coarse, ["zone"], ["v"]).collect()}
    spark.createDataFrame([], fine.schema).write.parquet(a)
    spark.createDataFrame([], coarse.schema).write.parquet(b)

    def stream():
        left = spark.readStream.schema("zone int, time timestamp").option("maxFilesPerTrigger", 1).parquet(a)
        right = spark.readStream.schema("zone int, time timestamp, v double").option("maxFilesPerTrigger", 1).parquet(b)
        return stateful.asof_fill(left, right, "zone", "v", late="3 days")

    fine.filter("time < TIMESTAMP'2001-01-03'").repartition(2).write.mode("append").parquet(a)
    coarse.filter("zone = 1").repartition(1).write.mode("append").parquet(b)
    run(stream(), tmp_path)
    fine.filter("time >= TIMESTAMP'2001-01-03'").repartition(2).write.mode("append").parquet(a)
    coarse.filter("zone = 2").repartition(1).write.mode("append").parquet(b)
    run(stream(), tmp_path)
    spark.sql(END).coalesce(1).write.mode("append").parquet(a)
    run(stream(), tmp_path)
    rows = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("zone", "time", "v").collect()]
    assert len(rows) == len(want) and {(z, t): v for z, t, v in rows} == want


def test_alarms_and_late_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    add = lambda text: spark.sql(text).coalesce(1).write.mode("append").parquet(path)
    stream = lambda: stateful.gap_alarms(spark.readStream.schema("zone int, time timestamp").option("maxFilesPerTrigger", 1).parquet(path), "zone", 6 * 3600, late="1 hour")
    add("SELECT * FROM VALUES (1, TIMESTAMP'2001-01-01 00:00:00'), (2, TIMESTAMP'2001-01-01 00:00:00') AS t(zone, time)")
    run(stream(), tmp_path)
    add("SELECT * FROM VALUES (1, TIMESTAMP'2001-01-01 05:00:00'), (1, TIMESTAMP'2001-01-01 09:00:00') AS t(zone, time)")
    run(stream(), tmp_path)
    add("SELECT * FROM VALUES (1, TIMESTAMP'2001-01-01 12:00:00'), (2, TIMESTAMP'2001-01-01 01:00:00') AS t(zone, time)")
    query = run(stream(), tmp_path)
    assert stateful.late_rows(query) == 1
    alarms = lambda: sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).selectExpr("zone", "CAST(last AS STRING)", "limit_seconds").collect())
    told = alarms()
    assert told == [(2, "2001-01-01 00:00:00", 21600)]
    add("SELECT 99 AS zone, TIMESTAMP'2001-02-01' AS time")
    run(stream(), tmp_path)
    assert alarms() == [(1, "2001-01-01 12:00:00", 21600), (2, "2001-01-01 00:00:00", 21600)]
    assert spark.read.parquet(path).filter(F.col("zone") == 2).count() == 2
