"""Gridded sources: names of their files, lists of granules, tidy rows to canonical tables, and the read-through fetch.

A loader makes tidy rows (date, variable, time, lat, lon, value) of the (date,
variable) pairs that it is given; where they come from (files of a decoder's making,
another table) is its own business.  Every source fetches alike: the pairs that the
store lacks are loaded and kept, then all wanted rows become one wide table with
canonical names and units, clipped to a box.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.operators.spatial import BoundingBox, clip_grid, wrap_longitude
from isohyet.operators.store import read_through
from isohyet.operators.time import complete
from isohyet.sources import decode
from isohyet.sources.canonical import RESOLUTION, SOURCES, canonical

Loader = Callable[[DataFrame], DataFrame]
PRISM_RESOLUTIONS = {"4km": "25m", "800m": "30s"}
# Names of a radar file's precipitation, and words by which it is known otherwise.
RAIN_NAMES, RAIN_WORDS = ("unknown", "paramId_0", "tp", "APCP"), ("precip", "rain")


def prism_zip(variable: str, day: date, resolution: str = "4km") -> str:
    """Name of a day's archive; unknown variables and resolutions are errors."""
    if resolution not in PRISM_RESOLUTIONS or variable not in SOURCES["prism"]:
        raise ValueError(f"no variable {variable!r} at {resolution!r}: {', '.join(SOURCES['prism'])} at {', '.join(PRISM_RESOLUTIONS)}")
    return f"prism_{variable}_{resolution}_{day:%Y%m%d}.zip"


def prism_raster(variable: str, day: date, resolution: str = "4km") -> str:
    """Name of the raster in it."""
    prism_zip(variable, day, resolution)
    return f"prism_{variable}_us_{PRISM_RESOLUTIONS[resolution]}_{day:%Y%m%d}.tif"


def prism_release(texts: DataFrame, column: str = "json") -> DataFrame:
    """Release records: data_date, release_date, element, grid_count, data_url."""
    kind = "data_date string, release_date string, element string, grid_count string, data_url string"
    made = texts.select(F.from_json(column, kind).alias("r")).select("r.*")
    return made.withColumns({"data_date": F.col("data_date").try_cast("date"), "release_date": F.col("release_date").try_cast("date"), "grid_count": F.col("grid_count").try_cast("int")})


def granules(spark: SparkSession, path: str, start: date, end: date, pattern: str = r"(\d{8})") -> DataFrame:
    """path and date of the files below a path whose names hold a date of the range; none at all is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    dated = files.withColumn("date", F.try_to_date(F.regexp_extract(F.element_at(F.split("path", "/"), -1), pattern, 1), "yyyyMMdd"))
    found = dated.filter(F.col("date").between(F.lit(start), F.lit(end)))
    if found.isEmpty():
        raise ValueError(f"no granules from {start} to {end} in {path}")
    return found


def granule_loader(
    spark: SparkSession, folder: str, source: str, box: BoundingBox | None = None, pattern: str = r"(\d{8})", glob: str | None = None, rename: dict[str, str] | None = None, on_error: str = "raise",
) -> Loader:
    """A loader for ``fetch`` over a folder of granules, whose names hold their days.

    Files of other days are not opened, and variables and the box are cut inside a
    file before its values are unpacked.  ``rename`` maps names in files to the
    source's; a radar field's own names are known.  Files that can't be read raise,
    or are left out with ``on_error="skip"`` (``decode.decode`` lists them).
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    step = RESOLUTION.get(source, 0.0)
    padded = box and BoundingBox(box.west - step / 2, box.south - step / 2, box.east + step / 2, box.north + step / 2)
    names = dict(rename or {}) | ({n: "precip_mm" for n in RAIN_NAMES} if source == "mrms" else {})

    def load(pairs: DataFrame) -> DataFrame:
        span = pairs.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
        wanted = {r["variable"] for r in pairs.select("variable").distinct().collect()}
        asked = tuple(sorted(wanted | {n for n, to in names.items() if to in wanted}))
        start, end = (span["a"], span["b"]) if span["a"] else (date.max, date.min)
        rows = decode.decode(decode.files(spark, folder, start, end, pattern, glob), decode.Window(asked, padded))
        if on_error == "raise":
            bad = F.raise_error(F.concat("path", F.lit(": "), "error")).cast("string")
            rows = rows.withColumn("variable", F.when(F.col("error").isNotNull(), bad).otherwise(F.col("variable")))
        else:
            rows, _ = decode.split_errors(rows)
        variable = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("variable")), "variable") if names else F.col("variable")
        told = rows.select(decode.name_date(F.element_at(F.split("path", "/"), -1), pattern).alias("date"), variable.alias("variable"), "time", "lat", "lon", "value")
        return told.join(pairs.select("date", "variable").distinct(), ["date", "variable"], "left_semi")

    return load


def assemble(parts: list[DataFrame], keys: list[str], time: str = "time") -> DataFrame:
    """Granules one after another by their own times; hours that none has are rows without values, never invented ones."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return complete(first, keys, {}, time)


def radar(df: DataFrame) -> DataFrame:
    """Radar rows with lat, lon from -180 to 180, and the precipitation variable, whatever it is called, as precip_mm."""
    df = df.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})
    data = [c for c in df.columns if c not in ("time", "lat", "lon")]
    named = [c for c in data if c in RAIN_NAMES or any(w in c.lower() for w in RAIN_WORDS)] or data
    if not named:
        raise ValueError("no data variable")
    return df.select("time", "lat", wrap_longitude(F.col("lon")).alias("lon"), F.col(named[0]).cast("double").alias("precip_mm"))


def wide(tidy: DataFrame, variables: list[str]) -> DataFrame:
    """Tidy rows to a column per variable; the names are given, so that no pass looks for them.  Of rows that repeat the greatest value stays."""
    return tidy.groupBy("time", "lat", "lon").pivot("variable", variables).agg(F.max("value"))


def fetch(
    spark: SparkSession, source: str, store: str, start: date, end: date, load: Loader, variables: list[str] | None = None, box: BoundingBox | None = None, resolution: str | None = None,
) -> DataFrame:
    """The canonical table of a source from start to end (both included), by the store where it has the data, else by the loader.

    The store is kept by source and extent: a request for a wider box does not
    find the rows of a narrower one.
    """
    if source not in SOURCES:
        raise ValueError(f"source must be one of {', '.join(SOURCES)}")
    wanted = variables or list(SOURCES[source])
    if unknown := [v for v in wanted if v not in SOURCES[source]]:
        raise ValueError(f"{source} has no {', '.join(unknown)}")
    step = RESOLUTION.get(f"{source}_{resolution}" if resolution else source, RESOLUTION.get(source))
    if resolution and f"{source}_{resolution}" not in RESOLUTION:
        raise ValueError(f"{source} has no resolution {resolution}")
    days = [start + timedelta(k) for k in range((end - start).days + 1)]
    pairs = spark.createDataFrame([(d, v) for d in days for v in wanted], "date date, variable string")
    extent = "all" if box is None else "_".join(f"{x:g}" for x in (box.west, box.south, box.east, box.north))
    rows = read_through(spark, f"{store}/{source}{resolution or ''}/{extent}", pairs, lambda p: _inside(load(p), box, step))
    return canonical(wide(rows, wanted), source)


def _inside(tidy: DataFrame, box: BoundingBox | None, step: float | None) -> DataFrame:
    return tidy if box is None else clip_grid(tidy, box, step or 0.0, step or 0.0)
