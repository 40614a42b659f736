"""Station tables and observations from CSV, JSON and HTML texts."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.operators.spatial import BoundingBox
from isohyet.operators.store import read_through

# Observation codes and column names of the networks.
ASOS = {"tmpf": "air_temp_f", "dwpf": "dewpoint_f", "relh": "relative_humidity", "sknt": "wind_speed_kt", "drct": "wind_direction_deg", "gust": "wind_gust_kt", "p01i": "precip_1hr_in", "mslp": "pressure_mb", "alti": "altimeter_inhg", "vsby": "visibility_mi", "skyc1": "sky_cover_1", "feel": "feels_like_f"}
RWIS = {k: ASOS[k] for k in ("tmpf", "dwpf", "relh", "sknt", "drct", "gust", "feel")}
NDAWN_HOURLY = {"hdt": "Avg Air Temp", "hdrh": "Avg Rel Hum", "hdbst": "Avg Bare Soil Temp", "hdtst": "Avg Turf Soil Temp", "hdws": "Avg Wind Speed", "hdmxws": "Max Wind Speed", "hdwd": "Avg Wind Dir", "hdsdwd": "Avg Wind Dir SD", "hdsr": "Avg Sol Rad", "hdr": "Total Rainfall", "hdbp": "Avg Baro Press", "hddp": "Avg Dew Point", "hdwc": "Avg Wind Chill"}
SYNOPTIC = ("air_temp", "dew_point_temperature", "relative_humidity", "wind_speed", "wind_direction", "wind_gust", "precip_accum_one_hour", "solar_radiation", "pressure")
GEOJSON = "features array<struct<properties:struct<sid:string,sname:string,elevation:double,network:string>,geometry:struct<coordinates:array<double>>>>"


def clean_name(name: str) -> str:
    """Lower case, trimmed, other characters to single underscores."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def clean_text(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[^0-9a-z]+", "_"), "^_+|_+$", "")


def geojson_stations(texts: DataFrame, column: str = "json", box: BoundingBox | None = None) -> DataFrame:
    """Station rows of GeoJSON feature collections; unreadable texts give none."""
    rows = texts.select(F.explode(F.from_json(column, GEOJSON)["features"]).alias("f"))
    made = rows.select(F.col("f.properties.sid").alias("stid"), F.col("f.properties.sname").alias("name"), F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), F.get("f.geometry.coordinates", F.lit(0)).alias("lon"), F.col("f.properties.elevation").alias("elevation"), F.col("f.properties.network").alias("network"))
    made = made.dropna(subset=["lat", "lon"])
    return made.filter(box.holds(F.col("lat"), F.col("lon"))) if box else made


def html_fields(pages: DataFrame, column: str, patterns: dict[str, str], required: tuple[str, ...] = ()) -> DataFrame:
    """One column per pattern's first group; rows lacking a required one go."""
    found = {name: F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")) for name, pattern in patterns.items()}
    return pages.withColumns(found).dropna(subset=list(required) or None, how="any") if required else pages.withColumns(found)


def labelled_cell(page: Column, label: str) -> Column:
    """What the table cell after a label says, up to the next tag; NULL where a page lacks the label or a cell after it."""
    pieces = F.split(page, "(?i)<td[^>]*>")
    at = F.array_position(F.transform(pieces, lambda p: p.contains(f"{label}:")), True)
    return F.trim(F.regexp_replace(F.substring_index(F.when(at > 0, F.get(pieces, at.cast("int"))), "<", 1), r"\s+", " "))


def leading_number(text: Column) -> Column:
    """The number that a text begins with, whatever unit follows."""
    return F.regexp_extract(text, r"^\s*([-+]?\d+(?:\.\d*)?)", 1).try_cast("double")


def csv_rows(lines: DataFrame, header: str, column: str = "value") -> DataFrame:
    """String columns of CSV lines under the one header line that matches a pattern; names are cleaned, all lines are read in parallel."""
    found = lines.filter(F.col(column).rlike(header)).select(F.rtrim(column, F.lit("\r")).alias("h")).distinct().limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{len(found) or 'no'} header lines like {header}: read files of one layout at a time")
    names = [clean_name(c) for c in next(csv.reader([found[0]["h"]]))]
    rows = lines.filter(~F.col(column).rlike(header)).withColumn(column, F.rtrim(column, F.lit("\r")))
    return rows.select(F.from_csv(column, ", ".join(f"`{n}` string" for n in names)).alias("c")).select("c.*")


def iem_rows(lines: DataFrame, kind: str = "asos", column: str = "value") -> DataFrame:
    """station, valid and the network's variables from CSV lines with # comments; M and empty cells are missing, times are UTC in valid or obtime."""
    names = {"asos": ASOS, "rwis": RWIS}[kind]
    raw = csv_rows(lines.filter(~F.col(column).startswith("#")), "(?i)^station,", column)
    time = "obtime" if "obtime" in raw.columns else "valid"
    held = lambda k: F.when(~F.trim(k).isin("M", ""), F.trim(k))
    values = [(held(k) if k == "skyc1" else held(k).try_cast("double")).alias(v) for k, v in names.items() if k in raw.columns]
    return raw.select("station", F.to_timestamp_ntz(F.substring(time, 1, 16), F.lit("yyyy-MM-dd HH:mm")).alias("valid"), *values)


def parse_iem(spark: SparkSession, path: str, kind: str = "asos") -> DataFrame:
    return iem_rows(spark.read.text(path), kind)


def ndawn_rows(lines: DataFrame, hourly: bool = True, column: str = "value") -> DataFrame:
    """Observations from CSV lines with a preamble and a row of units, which have no year; hour-ending HHMM becomes the hour's beginning (CST)."""
    raw = csv_rows(lines, "^Station Name,", column).filter(F.trim("year").rlike(r"^\d{4}$"))
    text = {"station_name"}
    made = raw.select(*[(F.trim(n) if n in text else F.trim(n).try_cast("double")).alias(n) for n in raw.columns])
    hour = (F.col("hour") / 100 - 1).cast("int") if hourly else F.lit(0)
    time = F.make_timestamp_ntz(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"), hour, F.lit(0), F.lit(0).cast("decimal(8,6)"))
    return made.withColumn("time", time)


def parse_ndawn(spark: SparkSession, path: str, hourly: bool = True) -> DataFrame:
    return ndawn_rows(spark.read.text(path), hourly)


def ndawn_links(pages: DataFrame, column: str = "html") -> DataFrame:
    """name, internal_id and url of the stations that a map page links; links to other pages go."""
    tags = pages.select(F.explode(F.regexp_extract_all(column, F.lit("(?i)<area\\b[^>]*>"), F.lit(0))).alias("tag"))
    said = lambda name: F.nullif(F.regexp_extract("tag", f'(?i)\\b{name}="([^"]*)"', 1), F.lit(""))
    found = tags.select(said("title").alias("name"), said("href").alias("url"))
    return found.select("name", F.try_parse_url("url", F.lit("QUERY"), F.lit("station")).alias("internal_id"), "url").dropna()


def ndawn_details(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages with lat, lon, elevation_ft and period_of_record; pages without coordinates go."""
    cell = lambda label: labelled_cell(F.col(column), label)
    found = {"lat": leading_number(cell("Latitude")), "lon": leading_number(cell("Longitude")), "elevation_ft": leading_number(cell("Elevation")), "period_of_record": cell("Period of record")}
    return pages.withColumns(found).dropna(subset=["lat", "lon"])


def with_station_id(observations: DataFrame, stations: DataFrame, name: str = "station_name") -> DataFrame:
    """Observations with the internal_id of their station's name."""
    return observations.join(stations.select(F.col("name").alias(name), "internal_id"), name, "left")


def one_per_station(stations: DataFrame, key: str = "station") -> DataFrame:
    return stations.dropDuplicates([key])


def grid_code(number: Column, width: int) -> Column:
    """A cell or station number as text of a width, zeros in front."""
    return F.lpad(number.cast("string"), width, "0")


def from_grid_code(code: Column, start: int, width: int) -> Column:
    return F.substring(code, start, width).cast("int")


def json_field(column: str, name: str, kind: str) -> Column:
    return F.from_json(column, f"`{name}` {kind}")[name]


def rename_codes(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Named observation columns to their short codes."""
    back = {clean_name(v): k for k, v in names.items()}
    return df.select(*[F.col(c).alias(back.get(c, c)) for c in df.columns])


def synoptic_stations(texts: DataFrame, column: str = "json", box: BoundingBox | None = None, active_only: bool = False) -> DataFrame:
    kind = "STATION array<struct<STID:string,NAME:string,LATITUDE:string,LONGITUDE:string,ELEVATION:string,MNET_ID:string,MNET_SHORTNAME:string,STATUS:string>>"
    s = F.explode(F.from_json(column, kind)["STATION"]).alias("s")
    number = lambda n: F.col(f"s.{n}").try_cast("double")
    made = texts.select(s).select(
        F.col("s.STID").alias("stid"), F.col("s.NAME").alias("name"), number("LATITUDE").alias("lat"), number("LONGITUDE").alias("lon"), number("ELEVATION").alias("elevation"),
        F.col("s.MNET_SHORTNAME").alias("network"), F.col("s.MNET_ID").alias("mnet_id"), (F.col("s.STATUS") == "ACTIVE").alias("active"),
    )
    made = made.filter("active") if active_only else made
    return in_box(made, box) if box else made


def synoptic_hourly(texts: DataFrame, variables: Sequence[str] = SYNOPTIC, column: str = "json") -> DataFrame:
    """stid, time (UTC) and one column per variable from time series documents, whose arrays lie beside the array of times."""
    kind = "STATION array<struct<STID:string,OBSERVATIONS:map<string,array<string>>>>"
    s = texts.select(F.explode(F.from_json(column, kind)["STATION"]).alias("s"))
    rows = s.select(F.col("s.STID").alias("stid"), F.col("s.OBSERVATIONS").alias("o"), F.posexplode(F.col("s.OBSERVATIONS")["date_time"]).alias("_k", "_t"))
    time = F.to_timestamp_ntz(F.regexp_replace(F.substring("_t", 1, 16), "T", " "), F.lit("yyyy-MM-dd HH:mm"))
    value = lambda v: F.get(F.coalesce(F.try_element_at("o", F.lit(f"{v}_set_1")), F.try_element_at("o", F.lit(v))), F.col("_k")).try_cast("double")
    return rows.select("stid", time.alias("time"), *[value(v).alias(v) for v in variables])


def synoptic_precipitation(texts: DataFrame, column: str = "json") -> DataFrame:
    """stid, time (the interval's last report, UTC) and precip_mm of hourly intervals."""
    kind = "STATION array<struct<STID:string,OBSERVATIONS:struct<precipitation:array<struct<last_report:string,total:string>>>>>"
    s = texts.select(F.explode(F.from_json(column, kind)["STATION"]).alias("s"))
    rows = s.select(F.col("s.STID").alias("stid"), F.explode("s.OBSERVATIONS.precipitation").alias("p"))
    time = F.to_timestamp_ntz(F.regexp_replace(F.substring("p.last_report", 1, 16), "T", " "), F.lit("yyyy-MM-dd HH:mm"))
    return rows.select("stid", time.alias("time"), F.col("p.total").try_cast("double").alias("precip_mm"))


#: Kinds of station texts: how their lines or documents become rows, and the columns of station and time.
FORMATS: dict[str, tuple[Callable[[DataFrame], DataFrame], str, str]] = {
    "asos": (lambda told: iem_rows(told, "asos"), "station", "valid"),
    "rwis": (lambda told: iem_rows(told, "rwis"), "station", "valid"),
    "ndawn_hourly": (lambda told: ndawn_rows(told, True), "station_name", "time"),
    "ndawn_daily": (lambda told: ndawn_rows(told, False), "station_name", "time"),
    "synoptic_hourly": (lambda told: synoptic_hourly(told), "stid", "time"),
    "synoptic_precipitation": (lambda told: synoptic_precipitation(told), "stid", "time"),
}


def fetch(spark: SparkSession, kind: str, store: str, stations: DataFrame, start: date, end: date, load: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Observations of stations (a column station) from start to end (both included), by the store where it has them, else by the loader.

    ``load`` gets the (date, station) pairs that the store lacks and makes their
    texts, as the network serves them; parsed rows are kept by pair, so a station
    is a source like any other.
    """
    if kind not in FORMATS:
        raise ValueError(f"kind must be one of {', '.join(FORMATS)}")
    parse, station, time = FORMATS[kind]
    days = F.explode(F.sequence(F.lit(start), F.lit(end)))
    wanted = stations.select(F.col("station").cast("string").alias("variable"), days.alias("date"))

    def rows(pairs: DataFrame) -> DataFrame:
        parsed = parse(load(pairs.withColumnRenamed("variable", "station")))
        return parsed.withColumns({"date": F.to_date(time), "variable": F.col(station)})

    return read_through(spark, f"{store}/{kind}", wanted, rows).drop("date", "variable")


def in_box(stations: DataFrame, box: BoundingBox) -> DataFrame:
    return stations.filter(box.holds(F.col("lat"), F.col("lon")))


def distinct_stations(observations: DataFrame, key: str = "station_name") -> DataFrame:
    return observations.groupBy(key).agg(F.min("latitude").alias("lat"), F.min("longitude").alias("lon"), F.min("elevation").alias("elevation"))


def geojson_polygons(texts: DataFrame, column: str, name: str) -> DataFrame:
    """Polygon features as key and rings array<array<struct<x,y>>>; a missing key property is an error."""
    kind = f"features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    rows = texts.select(F.explode(F.from_json(column, kind)["features"]).alias("f"))
    key = F.coalesce(F.col("f.properties")[name], F.raise_error(F.lit(f"a feature lacks the property {name}")).cast("string"))
    rings = F.transform("f.geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return rows.select(key.alias(name), rings.alias("rings"))
