import datetime
import math

import pytest
from pyspark.sql import functions as F

from isohyet.operators import cascade, disaggregate, legacy, spatial, store, time
from isohyet.sources import canonical, gridded, stations
from isohyet.streaming import rollup

GRID = spatial.Grid(44.0, -96.0, 0.1, 0.1, 20, 30)


def rectangle(spark, r0, r1, c0, c1, name=1):
    return spark.createDataFrame([(name, 44 + 0.1 * r0, 44 + 0.1 * r1, -96 + 0.1 * c0, -96 + 0.1 * c1)], "polygon_index int, south double, north double, west double, east double")


def test_reference_weights(spark):
    got = {(r.lat_idx, r.lon_idx): r.overlap for r in spatial.rectangle_overlaps(rectangle(spark, 4.25, 5.25, 4.25, 6.25), GRID).collect()}
    want = {(4, 4): 9 / 16, (4, 5): 12 / 16, (4, 6): 3 / 16, (5, 4): 3 / 16, (5, 5): 4 / 16, (5, 6): 1 / 16}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-3 for k, v in want.items())
    assert sum(got.values()) == pytest.approx(2, abs=1e-4)


def test_coverage_and_policies(spark):
    corner = spatial.rectangle_overlaps(rectangle(spark, -1, 1, -1, 1), GRID)
    assert spatial.rectangle_coverage(corner, "polygon_index").first().coverage == pytest.approx(0.25, abs=1e-3)
    assert spatial.build_weights(corner, "polygon_index").count() == 0
    kept = spatial.build_weights(corner, "polygon_index", on_low_coverage="keep")
    assert kept.agg(F.sum("weight")).first()[0] == pytest.approx(1)
    with pytest.raises(Exception, match="low coverage"):
        spatial.build_weights(corner, "polygon_index", on_low_coverage="error").collect()


def test_polygon_with_hole(spark):
    box = lambda w, s, e, n: [{"x": w, "y": s}, {"x": e, "y": s}, {"x": e, "y": n}, {"x": w, "y": n}]
    rings = [box(-95.6, 44.4, -95.2, 44.8), box(-95.5, 44.5, -95.4, 44.6)]
    df = spark.createDataFrame([(1, rings)], "k int, rings array<array<struct<x:double,y:double>>>")
    cells = spatial.polygon_overlaps(df, GRID, "k").filter("overlap > 1e-6")
    assert cells.count() == 15
    assert cells.agg(F.sum("overlap")).first()[0] == pytest.approx(15, abs=1e-6)


def test_clip_grid_keeps_edge_cells(spark):
    cells = spatial.generate_grid(spark, spatial.BoundingBox(-96, 44, -93, 46), 0.1)
    box = spatial.BoundingBox(-95.5, 44.4, -94.9, 45.0)
    ids = {r.column_id for r in spatial.clip_grid(cells, box, 0.1, 0.1).collect()}
    assert min(ids) in (4, 5) and max(ids) in (10, 11)
    assert box.contains(spatial.BoundingBox(-95.4, 44.5, -95, 44.9)) and not box.contains(spatial.DEFAULT_REGION)


def test_asof_takes_labels_not_values(spark):
    fine = spark.sql("SELECT 1 AS k, explode(sequence(TIMESTAMP_NTZ'2001-01-01', TIMESTAMP_NTZ'2001-01-03', INTERVAL 12 HOUR)) AS time")
    coarse = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2001-01-01 06:00:00', 5e0), (1, TIMESTAMP_NTZ'2001-01-02', NULL) AS t(k, time, v)")
    got = [r.v for r in time.asof(fine, coarse, ["k"], ["v"]).orderBy("time").collect()]
    assert got == [None, 5.0, None, None, None]


def test_infer_step(spark):
    even = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2001-01-01', TIMESTAMP_NTZ'2001-01-02', INTERVAL 6 HOUR)) AS time")
    assert time.infer_step_seconds(even) == 21600
    assert time.infer_step_seconds(even.limit(1)) == 86400
    with pytest.raises(ValueError):
        time.infer_step_seconds(even.unionByName(spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01 01:00:00' AS time")))


def days(spark, values):
    rows = ", ".join(f"(1, TIMESTAMP_NTZ'2001-06-{i + 1:02d}', CAST({v} AS DOUBLE), 45e0)" for i, v in enumerate(values))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(zone, time, v, lat)")


@pytest.mark.parametrize("method", ["trapezoidal", "diurnal", "static", "solar"])
def test_sums_are_conserved(spark, method):
    daily = days(spark, [3, 0, 7])
    daily = daily.withColumn("lon", F.lit(-95.0))
    got = disaggregate.disaggregate(daily, "sum", ["zone"], "v", weight_method=method, lat="lat", lon="lon")
    sums = time.resample(got, ["zone"], [F.sum("v").alias("v"), F.count("v").alias("n")]).orderBy("time").collect()
    assert [r.v for r in sums] == pytest.approx([3, 0, 7]) and [r.n for r in sums] == [24] * 3


def test_dispatch_errors(spark):
    daily = days(spark, [1])
    for bad in ({"conservation": "other"}, {"conservation": "sum", "weight_method": "other"}, {"conservation": "mean_additive"}):
        with pytest.raises(ValueError):
            disaggregate.disaggregate(daily, bad["conservation"], ["zone"], "v", weight_method=bad.get("weight_method", "static"))
    with pytest.raises(ValueError):
        disaggregate.diurnal(F.col("time"), [1.0])
    with pytest.raises(ValueError, match="longitude"):
        disaggregate.disaggregate(daily, "sum", ["zone"], "v", weight_method="solar", lat="lat")
    mixed = daily.unionByName(daily.withColumn("time", F.col("time") + F.expr("INTERVAL '5' HOUR")))
    with pytest.raises(ValueError, match="offset_hours"):
        disaggregate.disaggregate(mixed, "sum", ["zone"], "v", weight_method="static")


def test_solar_weights_follow_the_longitude(spark):
    """At -95 degrees the sun peaks more than six hours after Greenwich."""
    daily = days(spark, [24])
    peak = {}
    for lon in (0.0, -95.0):
        got = disaggregate.disaggregate(daily.withColumn("lon", F.lit(lon)), "sum", ["zone"], "v", weight_method="solar", lat="lat", lon="lon")
        peak[lon] = got.orderBy(F.desc("v")).first().time.hour
    assert peak[0.0] in (11, 12) and peak[-95.0] in (18, 19)


def test_cascade_conserves_mass_and_repeats(spark):
    daily = days(spark, [3, 0, 7.5])
    made = lambda n: cascade.to_hours(cascade.cascade(daily.repartition(n), "zone", "v", seed=4), "zone", "v")
    sums = {r._period.day: r.s for r in made(1).groupBy("_period").agg(F.sum("v").alias("s")).collect()}
    assert sums == pytest.approx({1: 3, 3: 7.5})
    assert sorted(made(1).collect()) == sorted(made(3).collect())


def test_hybrid_mass(spark):
    fine = disaggregate.disaggregate(days(spark, [1, 0, 2]), "sum", ["zone"], "v", weight_method="diurnal").select("zone", "time", "v")
    got = cascade.hybrid(days(spark, [4, 6, 0]).drop("lat"), fine, "zone", "v")
    sums = [r.v for r in time.resample(got, ["zone"], [F.sum("v").alias("v")]).orderBy("time").collect()]
    assert sums == pytest.approx([4, 6, 0])


def test_fit_recovers_known_parameters_and_drives_the_cascade(spark):
    c, beta = 0.5, 0.35
    rows = [(z, q, q - c * (q * (1 - b) + b**q - 1) / math.log(2)) for z, b in ((1, beta), (2, 0.6)) for q in cascade.ORDERS] + [(3, 1.0, 0.4)]
    got = {r.k: r for r in cascade.fit_parameters(spark.createDataFrame(rows, "k int, q double, tau double"), "k").collect()}
    assert (got[1].beta, got[1].amplitude) == (pytest.approx(beta, abs=1e-3), pytest.approx(math.exp(c * (1 - beta)), abs=1e-3))
    assert got[2].beta == pytest.approx(0.6, abs=1e-3) and not got[3].fitted
    daily = days(spark, [3, 0, 7.5]).unionByName(days(spark, [3, 0, 7.5]).withColumn("zone", F.lit(2)))
    table = spark.createDataFrame([(1, 1.0, 1.0, 1.0)], "zone int, amplitude double, beta double, tau0 double")
    parts = cascade.cascade(daily, "zone", "v", table)
    even = [r.value for r in parts.filter("zone = 1 AND day(time) = 1").collect()]
    assert even == pytest.approx([3 / 32] * 32)  # never dry, all weights alike
    other = [r.value for r in parts.filter("zone = 2 AND day(time) = 1").collect()]
    assert sum(other) == pytest.approx(3) and max(other) > 6 / 32  # the default
    fine = disaggregate.disaggregate(days(spark, [0, 5, 2]), "sum", ["zone"], "v", weight_method="diurnal").select("zone", "time", "v")
    for method in ("hybrid", "molnar_burlando", "olsson"):
        made = cascade.disaggregate_precipitation(daily.filter("zone = 1").drop("lat"), fine, "zone", "v", method)
        sums = [r.v for r in time.resample(made, ["zone"], [F.sum("v").alias("v")]).orderBy("time").collect()]
        assert sums == pytest.approx([3, 0, 7.5])


def test_asof_carries_over_buckets(spark):
    fine = spark.sql("SELECT k, explode(sequence(TIMESTAMP_NTZ'2001-01-01', TIMESTAMP_NTZ'2001-12-31', INTERVAL 10 DAY)) AS time FROM VALUES (1), (2) AS t(k)")
    coarse = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2000-06-01', 5e0), (1, TIMESTAMP_NTZ'2001-08-01', NULL), (1, TIMESTAMP_NTZ'2002-06-01', 7e0) AS t(k, time, v)")
    back = {(r.k, r.time): r.v for r in time.asof(fine, coarse, ["k"], ["v"]).collect()}
    ahead = {(r.k, r.time): r.v for r in time.asof_forward(fine, coarse, ["k"], ["v"]).collect()}
    near = {(r.k, r.time): r.v for r in time.asof_nearest(fine, coarse, ["k"], "v").collect()}
    labels = [(r.time, r.v) for r in coarse.collect()]
    for (k, t), v in back.items():
        told = labels if k == 1 else []
        assert v == max([x for x in told if x[0] <= t], default=(None, None))[1]
        assert ahead[k, t] == min([x for x in told if x[0] >= t], default=(None, None))[1]
        assert near[k, t] == min([(abs(x[0] - t), x[0], x[1]) for x in told], key=lambda x: x[:2], default=(0, 0, None))[2]


def test_spine_and_gaps(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2001-01-01'), (2, TIMESTAMP_NTZ'2003-06-01 05:00:00'), (2, TIMESTAMP_NTZ'2003-06-01 02:00:00') AS t(k, time)")
    full = time.spine(df, ["k"])
    assert full.count() == 2 * (24 * 881 + 6) and full.filter("k = 1").agg(F.max("time")).first()[0].year == 2003
    assert time.spine(df, [], step="INTERVAL '1' DAY").count() == 882
    assert time.spine(df.limit(0), ["k"]).count() == 0
    assert {r.k: r.max_gap_hours for r in time.gaps(df, ["k"]).collect()} == {1: None, 2: 3.0}
    assert time.gaps(df, []).first().max_gap_hours == pytest.approx(24 * 881 + 2)


def test_nelder_mead():
    x = cascade.nelder_mead(lambda p: (p[0] - 1) ** 2 + (p[1] + 2) ** 2, [0.4, 0.2])
    assert x == pytest.approx([1, -2], abs=1e-3)


def test_store(spark, tmp_path):
    df = spark.sql("SELECT 'A' AS metzone, 1e0 AS v, CAST(NULL AS STRING) AS error UNION ALL SELECT 'B', 2e0, 'failed'")
    errors = store.save_results(df, str(tmp_path / "out"), "m")
    assert [r.metzone for r in errors.collect()] == ["B"]
    assert store.read_partition(spark, str(tmp_path / "out"), metzone="A").count() == 1
    batch = spark.range(5).select("id")
    for _ in range(2):
        store.append_new(spark, batch, str(tmp_path / "log"), ["id"])
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5
    assert store.changed_by_day(spark, str(tmp_path / "log")).agg(F.sum("files")).first()[0] > 0
    assert store.file_counts(spark, str(tmp_path / "log")).agg(F.sum("rows")).first()[0] == 5
    weights = spatial.build_weights(spatial.rectangle_overlaps(rectangle(spark, 4, 6, 4, 6), GRID), "polygon_index")
    store.save_weights(weights, str(tmp_path / "weights"), "polygon_index")
    assert spark.read.parquet(str(tmp_path / "weights")).count() == weights.count()
    store.compact(spark, str(tmp_path / "log"), str(tmp_path / "few"), "id", 3)
    assert spark.read.parquet(str(tmp_path / "few")).count() == 5


def test_data_sets_by_number(spark, tmp_path):
    zones = spark.sql("SELECT * FROM VALUES (3, TIMESTAMP_NTZ'2001-01-01', 1e0, NULL), (3, TIMESTAMP_NTZ'2001-01-02', 2e0, 5e0) AS t(zone, time, rain, air)")
    rows = store.dsn_rows(zones, "zone", {"PREC": "rain", "ATEM": "air"})
    assert sorted((r.dsn, r.value) for r in rows.collect()) == [(103, 1.0), (103, 2.0), (163, 5.0)]
    path = str(tmp_path / "sets")
    store.export_dsn(spark, rows.filter("dsn = 103"), path)
    store.export_dsn(spark, rows.withColumn("value", F.lit(9.0)), path)  # 103 is there and stays
    assert sorted((r.dsn, r.value) for r in spark.read.parquet(path).collect()) == [(103, 1.0), (103, 2.0), (163, 9.0)]
    newer = spark.sql("SELECT 103 AS dsn, TIMESTAMP_NTZ'2001-01-02' AS time, 7e0 AS value")
    store.export_dsn(spark, newer, path, "update")
    assert sorted((r.dsn, r.value) for r in spark.read.parquet(path).collect()) == [(103, 1.0), (103, 7.0), (163, 9.0)]
    row = store.dsn_summary(rows).filter("dsn = 103").first()
    assert (row.kind, row.zone, row.n) == (10, 3, 2)
    with pytest.raises(ValueError):
        store.export_dsn(spark, rows, path, "other")


def test_legacy_checks(spark):
    box = spatial.BoundingBox(-96, 44, -95, 45)
    zones = rectangle(spark, 4, 6, 4, 6).unionByName(rectangle(spark, 4, 6, 25, 28, 2))
    day = datetime.date(2001, 1, 1)
    said = lambda until: sorted(tuple(r) for r in legacy.run_problems(zones, "polygon_index", box, day, until).collect())
    assert said(datetime.date(2001, 3, 1)) == [("2", "outside the extent")]
    assert said(datetime.date(2001, 1, 20)) == [("2", "outside the extent"), ("all", "fewer than 32 days")]
    assert said(datetime.date(2000, 1, 1))[1] == ("all", "the end is before the start")


def test_read_through(spark, tmp_path):
    """Only pairs that the store lacks are loaded, once; a pair without rows is not asked for again."""
    asked = []

    def load(pairs):
        asked.append(sorted((r.date.day, r.variable) for r in pairs.collect()))
        at = F.to_timestamp_ntz(F.col("date").cast("string"))
        rows = pairs.filter("variable <> 'Qair'").select("date", "variable", at.alias("time"), F.lit(44.5).alias("lat"), F.explode(F.array(F.lit(-95.0), F.lit(-80.0))).alias("lon"))
        return rows.withColumn("value", F.lit(273.15) + F.dayofmonth("date"))

    day = datetime.date(2001, 1, 1)
    box = spatial.BoundingBox(-96, 44, -94, 45)
    fetch = lambda until, names: gridded.fetch(spark, "nldas", str(tmp_path), day, day + datetime.timedelta(until), load, names, box)
    one = fetch(0, ["Tair"]).collect()
    assert [(r.temperature_c, r.lon) for r in one] == [(pytest.approx(1.0), -95.0)] and asked == [[(1, "Tair")]]
    two = fetch(1, ["Tair", "Qair"])
    assert [r.temperature_c for r in two.orderBy("time").collect()] == pytest.approx([1, 2]) and two.first().specific_humidity_kgkg is None
    assert asked[1:] == [[(1, "Qair"), (2, "Qair"), (2, "Tair")]]
    assert fetch(1, ["Tair", "Qair"]).count() == 2 and len(asked) == 2
    for bad in (("other", None, None), ("nldas", ["none"], None), ("prism", None, "1km")):
        with pytest.raises(ValueError):
            gridded.fetch(spark, bad[0], str(tmp_path), day, day, load, bad[1], None, bad[2])


def test_interrupted_and_doubled_loads(spark, tmp_path):
    """Rows of a run that never reached the manifest are not read; a pair that two runs loaded counts once."""
    wanted = spark.sql("SELECT DATE'2001-01-01' AS date, explode(array('a', 'b')) AS variable")
    load = lambda pairs: pairs.select("date", "variable", F.lit(1.0).alias("value"))
    assert store.read_through(spark, str(tmp_path), wanted, load).count() == 2
    load(wanted).withColumn("run", F.lit("dead")).write.mode("append").partitionBy("run", "date").parquet(f"{tmp_path}/rows")
    assert store.read_through(spark, str(tmp_path), wanted, load).count() == 2
    wanted.withColumn("run", F.lit("dead")).write.mode("append").parquet(f"{tmp_path}/manifest")
    assert store.read_through(spark, str(tmp_path), wanted, load).count() == 2
    assert store.read_through(spark, str(tmp_path / "none"), wanted.limit(0), load).count() == 0


def test_label_shape(spark):
    labels = lambda *days: spark.createDataFrame([(datetime.datetime(*d),) for d in days], "time timestamp_ntz")
    assert disaggregate.label_shape(labels((2001, 1, 1), (2001, 2, 1), (2001, 3, 1))) == (0, "month")
    assert disaggregate.label_shape(labels((2001, 1, 1), (2001, 3, 1))) == (0, "day")  # a daily series of two days
    assert disaggregate.label_shape(labels((2001, 1, 1, 12), (2001, 1, 2, 12), (2001, 1, 5, 12))) == (12, "day")
    with pytest.raises(ValueError, match="irregular"):
        disaggregate.label_shape(labels((2001, 1, 1), (2001, 1, 1, 7)))
    with pytest.raises(ValueError, match="irregular"):
        time.complete(labels((2001, 1, 1), (2001, 1, 2), (2001, 1, 2, 5)), [], {}, step=None)


def test_gridded_helpers(spark, tmp_path):
    day = datetime.date(2001, 2, 3)
    assert gridded.prism_zip("ppt", day) == "prism_ppt_4km_20010203.zip" and gridded.prism_raster("tmax", day, "800m") == "prism_tmax_us_30s_20010203.tif"
    with pytest.raises(ValueError):
        gridded.prism_zip("other", day)
    texts = spark.createDataFrame([('{"data_date":"2001-02-03","release_date":"2001-03-01","element":"ppt","grid_count":"7"}',)], "json string")
    row = gridded.prism_release(texts).first()
    assert (row.data_date, row.grid_count) == (day, 7)
    for name in ("a_20010203.grb", "a_20010301.grb", "other.txt"):
        (tmp_path / name).write_text("x")
    assert [r.date for r in gridded.granules(spark, str(tmp_path), day, day).collect()] == [day]
    with pytest.raises(ValueError, match="no granules"):
        gridded.granules(spark, str(tmp_path), datetime.date(1990, 1, 1), datetime.date(1990, 1, 2))
    hour = lambda h, v: spark.sql(f"SELECT 1 AS k, TIMESTAMP_NTZ'2001-01-01 {h:02d}:00:00' AS time, {v}e0 AS v")
    assert [r.v for r in gridded.assemble([hour(3, 3), hour(0, 0)], ["k"]).orderBy("time").collect()] == [0, None, None, 3]


def test_regrid_and_projection(spark):
    cells = spatial.generate_grid(spark, spatial.BoundingBox(-96, 44, -93, 46), 0.1).select(F.col("row_id").alias("lat_idx"), F.col("column_id").alias("lon_idx"), (2 * F.col("lat") + F.col("lon")).alias("v"), F.lit(0).alias("time"))
    targets = spark.createDataFrame([(1, 44.93, -94.37), (2, 45.5, -93.7)], "target_id int, lat double, lon double")
    got = {r.target_id: r.v for r in spatial.regrid(cells, targets, GRID, ["v"]).collect()}
    assert got == {1: pytest.approx(2 * 44.93 - 94.37), 2: pytest.approx(2 * 45.5 - 93.7)}  # bilinear is exact for planes
    x, y = spatial.lambert_point(50.0, -107.0)
    assert (x, y) == (pytest.approx(0, abs=1e-6), pytest.approx(0, abs=1e-6))
    row = spatial.on_conformal(targets).filter("target_id = 1").first()
    assert spatial.lambert_point(44.93, -94.37) == (pytest.approx(row.lon), pytest.approx(row.lat))


def test_ingest_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(2):
        spark.range(5 * k, 5 * k + 5).write.mode("append").parquet(source)
        rollup.ingest(spark, source, target, str(tmp_path / "log"), "id long", 1).awaitTermination(60)
        assert spark.read.parquet(target).count() == 5 * k + 5


def test_station_formats(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("title\ninfo\nmore\nStation Name,Latitude,Longitude,Elevation,Year,Month,Day,Hour,Avg Air Temp\n,deg,deg,ft,,,,CST,Degrees F\nFargo,46.9,-96.8,900,2001,6,1,100,55.5\nFargo,46.9,-96.8,900,2001,6,1,2400,bad\n")
    rows = stations.parse_ndawn(spark, str(path)).orderBy("time").collect()
    assert [r.time.hour for r in rows] == [0, 23] and [r.avg_air_temp for r in rows] == [55.5, None]
    iem = tmp_path / "i.csv"
    iem.write_text("#DEBUG\nstation,valid,tmpf,skyc1\nFAR,2001-06-01 00:53,60.1,CLR\nFAR,2001-06-01 01:53,M,M\n")
    got = stations.parse_iem(spark, str(iem)).orderBy("valid").collect()
    assert [r.air_temp_f for r in got] == [60.1, None] and got[0].sky_cover_1 == "CLR"
    polygons = spark.createDataFrame([('{"features":[{"properties":{"z":"A"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}}]}',)], "j string")
    assert stations.geojson_polygons(polygons, "j", "z").first().rings[0][1].x == 1.0


def test_canonical(spark):
    raw = spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01' AS time, 1e0 AS lat, 2e0 AS lon, CAST('NaN' AS DOUBLE) AS Tair, 3e0 AS Wind_E, 4e0 AS Wind_N")
    row = canonical.canonical(raw, "nldas").first()
    assert row.temperature_c is None and row.wind_speed_ms == 5.0
    assert canonical.available(raw, "nldas")[1][0] == "Qair"
    with pytest.raises(NotImplementedError):
        canonical.fetch_daymet()


def test_streaming_rollup(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT 1 AS k, explode(sequence(TIMESTAMP'2001-01-01', TIMESTAMP'2001-01-03 23:00:00', INTERVAL 1 HOUR)) AS time, 1e0 AS v").write.parquet(source)
    stream = rollup.daily_rollup(spark.readStream.schema("k int, time timestamp, v double").parquet(source), ["k"], "v")
    run = stream.writeStream.format("memory").queryName("rolled").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert [r.total for r in spark.table("rolled").orderBy("time").collect()] == [24.0] * 3
