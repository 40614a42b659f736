"""Meteorological shapes of the driver tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isohyet.operators.spatial import Grid

GRID = Grid(44.0, -96.0, 0.1, 0.1, 20, 30)

CELLS = """
SELECT l_orderkey, l_linenumber, CAST(l_partkey % 20 AS INT) AS lat_idx, CAST(l_suppkey % 30 AS INT) AS lon_idx,
       4.4e1 + 1e-1 * ((l_partkey % 20) + 5e-1) AS lat, -9.6e1 + 1e-1 * ((l_suppkey % 30) + 5e-1) AS lon,
       l_shipdate + INTERVAL '1' HOUR * l_linenumber AS time, 2.6315e2 + l_quantity AS tair_k, 1e-3 + l_discount * 1e-1 AS qair,
       9.5e4 + l_tax * 5e4 AS psurf_pa, l_quantity / 5e0 - 5e0 AS wind_e, l_discount * 1e2 - 5e0 AS wind_n,
       l_extendedprice / 1e2 AS swdown, 2e2 + l_tax * 2e3 AS lwdown, l_discount * 5e1 AS rainf
FROM lineitem"""

#: Rain in whole steps of 10801 / 2^20 mm: sums of them are exact in any order, and shares of them end in no tie at the sixth digit.
EXACT = "sum(CAST(round(value * 1e1) AS BIGINT)) * 1.0300636291503906e-2"

POLYGONS = """
SELECT n_nationkey AS polygon_index, n_regionkey AS metzone,
       4.4e1 + 1e-1 * (((n_nationkey * 7) % 16) + 2.5e-1 * (1 + n_nationkey % 3)) AS south,
       4.4e1 + 1e-1 * (((n_nationkey * 7) % 16) + 2.5e-1 * (1 + n_nationkey % 3) + 2.5e0) AS north,
       -9.6e1 + 1e-1 * (((n_nationkey * 11) % 26) + 2.5e-1 * (1 + n_nationkey % 2)) AS west,
       -9.6e1 + 1e-1 * (((n_nationkey * 11) % 26) + 2.5e-1 * (1 + n_nationkey % 2) + 3.25e0) AS east
FROM nation"""

_FINE = """
SELECT CAST(user_id % 5 AS INT) AS zone, CAST(date_trunc('hour', ts) AS {ntz}) AS time, {exact} AS precip_mm
FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY 1, 2"""

_COARSE = """
SELECT CAST(user_id % 5 AS INT) AS zone, CAST(date_trunc('day', ts - INTERVAL '12' HOUR) AS {ntz}) + INTERVAL '12' HOUR AS time,
       {exact} AS precip_mm
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""

STATIONS = """
SELECT s_suppkey AS station, s_name AS name, s_nationkey AS network, 4.4e1 + (s_suppkey % 20) / 1e1 AS lat, -9.6e1 + (s_suppkey % 30) / 1e1 AS lon,
       CAST(200 + s_suppkey % 300 AS DOUBLE) AS elevation_m
FROM supplier"""

DAILY_MET = """
SELECT l_orderkey, l_linenumber, l_shipdate AS date, l_quantity - 1e1 AS temp_mean_c, l_quantity - 1.5e1 AS temp_min_c, l_quantity - 5e0 AS temp_max_c,
       l_quantity - 1e1 - l_discount * 1e2 AS temp_dew_c, l_tax * 5e1 AS wind_ms, l_extendedprice / 2e3 AS solar_mj,
       4.4e1 + 1e-1 * ((l_partkey % 20) + 5e-1) AS lat, CAST(200 + l_suppkey % 300 AS DOUBLE) AS elevation_m
FROM lineitem"""

#: Daily rain on a second, coarser grid, labelled at noon before the day.
RAIN_GRID = Grid(44.0, -96.0, 0.2, 0.2, 10, 15)

DAILY_RAIN = """
SELECT CAST(l_partkey % 10 AS INT) AS lat_idx, CAST(l_suppkey % 15 AS INT) AS lon_idx, l_shipdate - INTERVAL '12' HOUR AS time,
       avg(CASE WHEN l_quantity < 2e1 THEN 0e0 ELSE l_quantity / 5e0 END) AS precip_mm
FROM lineitem GROUP BY 1, 2, 3"""

#: Time series of hours by zone, completed with zeros.
FINE_FULL = """
SELECT z.zone, h.time, coalesce(f.precip_mm, 0e0) AS precip_mm
FROM (SELECT DISTINCT zone FROM fine_gaps) z
CROSS JOIN (SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time FROM (SELECT min(time) AS a, max(time) AS b FROM fine_gaps)) h
LEFT JOIN fine_gaps f ON f.zone = z.zone AND f.time = h.time"""

TABLES = {"cells": "lineitem", "polygons": "nation", "fine_gaps": "events", "coarse": "events", "stations": "supplier", "daily_met": "lineitem", "daily_rain": "lineitem"}
SQL = {"cells": CELLS, "polygons": POLYGONS, "fine_gaps": _FINE.replace("{exact}", EXACT), "coarse": _COARSE.replace("{exact}", EXACT), "stations": STATIONS, "daily_met": DAILY_MET, "daily_rain": DAILY_RAIN}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shape as a DataFrame over the driver's Parquet table."""
    source = TABLES[name]
    text = SQL[name].replace("{ntz}", "TIMESTAMP_NTZ")
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def ctes(*names: str) -> str:
    """WITH clause of shapes for DuckDB; fine is fine_gaps completed."""
    held: dict[str, str] = {}
    for name in names:
        if name == "fine":
            held["fine_gaps"] = SQL["fine_gaps"].replace("{ntz}", "TIMESTAMP")
            held["fine"] = FINE_FULL
        else:
            held[name] = SQL[name].replace("{ntz}", "TIMESTAMP")
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in held.items())


def fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isohyet.operators.time import complete

    return complete(view(spark, sf_dir, "fine_gaps"), ["zone"], {"precip_mm": 0.0})
