"""Vector files of catchments as rows: shapefiles (plain or zipped), GeoPackage, GeoJSON and GeoParquet.

Files come as rows (path, content) and are read by one task each, so a file must fit
a task; the parts of a shapefile are brought together by their common stem.  Rings
are moved to longitude and latitude by the file's own coordinate system.  Nothing is
guessed: a file without a system, or with one that is not known, is an error, but
GeoJSON and GeoParquet without one are in longitude and latitude by their standards.

Defined cases: features without a polygon have null rings; deleted rows of a table
and their shapes go; attributes are text, null where blank; a broken file gives one
row with the error; no file, no rows.
"""

from __future__ import annotations

import io
import json
import re
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions.projection import Projection, from_text
from isohyet.operators import geometry as geo

SCHEMA = f"path string, feature long, properties map<string,string>, rings {geo.RINGS}, error string"
#: The parts of a shapefile that are read.
PARTS = ("shp", "dbf", "prj", "cpg")
ENDINGS = (*PARTS, "zip", "gpkg", "geojson", "json", "parquet", "geoparquet")
Feature = tuple[dict[str, str | None], list[np.ndarray] | None]


def wkb_rings(data: bytes) -> list[np.ndarray] | None:
    """Rings of a polygon or multipolygon in well-known binary (either byte order; heights and measures are passed over); null of other kinds."""
    rings: list[np.ndarray] = []

    def read(at: int) -> int:
        order = "<" if data[at] else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        flags, kind = kind >> 28, kind & 0x0FFFFFFF
        at += 9 if flags & 2 else 5
        width = 2 + (bool(flags & 8) or kind // 1000 in (1, 3)) + (bool(flags & 4) or kind // 1000 in (2, 3))
        (many,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind % 1000 in (6, 7):
            for _ in range(many):
                at = read(at)
        elif kind % 1000 == 3:
            for _ in range(many):
                (n,) = struct.unpack_from(order + "I", data, at)
                rings.append(np.frombuffer(data, order + "f8", n * width, at + 4).reshape(n, width)[:, :2].astype(float))
                at += 4 + 8 * n * width
        else:
            raise LookupError
        return at

    try:
        read(0)
    except LookupError:
        return None
    return rings


def shapes(data: bytes) -> Iterator[list[np.ndarray] | None]:
    """Rings of each record of a .shp file; shapes that are not polygons are null."""
    if len(data) < 100 or struct.unpack_from(">I", data)[0] != 9994:
        raise ValueError("not a shapefile")
    at = 100
    while at + 8 <= len(data):
        _, words = struct.unpack_from(">II", data, at)
        body, at = at + 8, at + 8 + 2 * words
        if at > len(data):
            raise ValueError("the shapefile ends inside a record")
        if struct.unpack_from("<I", data, body)[0] not in (5, 15, 25):
            yield None
            continue
        parts, many = struct.unpack_from("<II", data, body + 36)
        first = [*struct.unpack_from(f"<{parts}I", data, body + 44), many]
        xy = np.frombuffer(data, "<f8", 2 * many, body + 44 + 4 * parts).reshape(many, 2)
        yield [xy[a:b].astype(float) for a, b in zip(first, first[1:], strict=False)]


def table_rows(data: bytes, encoding: str) -> Iterator[dict[str, str | None] | None]:
    """Rows of a .dbf table as text; deleted ones are null."""
    many, head, width = struct.unpack_from("<IHH", data, 4)
    columns, at = [], 32
    while at < head - 1 and data[at] != 0x0D:
        columns.append((data[at : at + 11].split(b"\0")[0].decode(encoding), data[at + 16]))
        at += 32
    for k in range(many):
        row = data[head + k * width : head + (k + 1) * width]
        if len(row) < width:
            raise ValueError("the table ends inside a row")
        told, at = {}, 1
        for name, size in columns:
            told[name] = row[at : at + size].decode(encoding, "replace").strip("\0 ") or None
            at += size
        yield None if row[:1] == b"*" else told


def _shapefile(parts: dict[str, bytes]) -> tuple[str | None, Iterator[Feature]]:
    if "shp" not in parts:
        raise ValueError("a shapefile without its .shp part")
    told = parts.get("cpg", b"").decode("ascii", "ignore").strip().lower()
    encoding = "utf-8" if told.replace("-", "") in ("", "utf8", "65001") else f"cp{told}" if told.isdigit() else told

    def features() -> Iterator[Feature]:
        rings = list(shapes(parts["shp"]))
        rows = list(table_rows(parts["dbf"], encoding)) if "dbf" in parts else [{}] * len(rings)
        if len(rows) != len(rings):
            raise ValueError(f"{len(rings)} shapes for {len(rows)} rows")
        yield from ((row, ring) for row, ring in zip(rows, rings, strict=True) if row is not None)

    return parts["prj"].decode("utf-8", "replace") if "prj" in parts else None, features()


def _zipped(content: bytes) -> tuple[str | None, Iterator[Feature]]:
    with zipfile.ZipFile(io.BytesIO(content)) as packed:
        stems = [n[:-4] for n in packed.namelist() if n.lower().endswith(".shp")]
        if len(stems) != 1:
            raise ValueError(f"{len(stems)} shapefiles in the archive")
        return _shapefile({n.rsplit(".", 1)[1].lower(): packed.read(n) for n in packed.namelist() if n.rsplit(".", 1)[0] == stems[0]})


def _text(value: object) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value) if isinstance(value, dict | list | bool) else str(value)


def _geopackage(content: bytes) -> tuple[str | None, Iterator[Feature]]:
    base = sqlite3.connect(":memory:")
    base.deserialize(content)
    layers = base.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY table_name").fetchall()
    if len(layers) != 1:
        raise ValueError(f"{len(layers)} layers in the package")
    table, column, srs = layers[0]
    system = base.execute("SELECT organization, organization_coordsys_id, definition FROM gpkg_spatial_ref_sys WHERE srs_id = ?", (srs,)).fetchone()
    crs = None if system is None or srs in (-1, 0) else f"EPSG:{system[1]}" if str(system[0]).upper() == "EPSG" and not system[2] else system[2]

    def features() -> Iterator[Feature]:
        quoted = table.replace('"', '""')
        found = base.execute(f'SELECT * FROM "{quoted}" ORDER BY rowid')
        names = [d[0] for d in found.description]
        for row in found:
            told = dict(zip(names, row, strict=True))
            blob = told.pop(column)
            start = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] if blob else 0
            yield {n: _text(v) for n, v in told.items() if not isinstance(v, bytes)}, wkb_rings(blob[start:]) if blob and not blob[3] & 16 else None

    return crs, features()


def _geojson(content: bytes) -> tuple[str | None, Iterator[Feature]]:
    told = json.loads(content)
    if told.get("type") != "FeatureCollection":
        raise ValueError("not a feature collection")

    def features() -> Iterator[Feature]:
        for f in told["features"]:
            shape = f.get("geometry") or {}
            many = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}.get(shape.get("type"))
            rings = [np.array([p[:2] for p in ring], float).reshape(-1, 2) for polygon in many(shape["coordinates"]) for ring in polygon] if many else None
            yield {n: _text(v) for n, v in (f.get("properties") or {}).items()}, rings

    return ((told.get("crs") or {}).get("properties") or {}).get("name", "OGC:CRS84"), features()


def _geoparquet(content: bytes) -> tuple[str | None, Iterator[Feature]]:
    file = pq.ParquetFile(pa.BufferReader(content))
    told = json.loads((file.schema_arrow.metadata or {}).get(b"geo", b"{}"))
    if not told:
        raise ValueError("a Parquet file without geometry")
    column = told["primary_column"]
    crs = told["columns"][column].get("crs", "OGC:CRS84")
    if isinstance(crs, dict):
        named = crs.get("id") or {}
        crs = f"{named.get('authority')}:{named.get('code')}"

    def features() -> Iterator[Feature]:
        for batch in file.iter_batches(1024):
            for row in batch.to_pylist():
                blob = row.pop(column)
                yield {n: _text(v) for n, v in row.items() if not isinstance(v, bytes)}, wkb_rings(blob) if blob else None

    return None if crs is None else "OGC:CRS84" if str(crs).startswith("OGC:CRS84") else crs, features()


def read(path: str, parts: dict[str, bytes]) -> tuple[str | None, Iterator[Feature]]:
    """The coordinate system and the features of one file by its ending."""
    ending = path.rsplit(".", 1)[-1].lower()
    if ending in PARTS:
        return _shapefile(parts)
    known = {"zip": _zipped, "gpkg": _geopackage, "geojson": _geojson, "json": _geojson, "parquet": _geoparquet, "geoparquet": _geoparquet}
    if ending not in known:
        raise ValueError(f"no vector format ends in {ending}")
    return known[ending](parts[ending])


def moved(rings: list[np.ndarray], source: Projection) -> list[np.ndarray]:
    """Rings in longitude and latitude."""
    return [np.stack(source.inverse(r[:, 0], r[:, 1]), axis=1) for r in rings]


def decode(files: DataFrame, crs: str | None = None) -> DataFrame:
    """path, feature, properties, rings (longitude, latitude) and error of files (path, content).

    ``crs`` (an EPSG number as ``EPSG:<n>``, or well-known text) holds for files that name none.
    """
    ending = F.lower(F.element_at(F.split("path", r"\."), -1))
    told = files.select("path", "content", ending.alias("ending"))
    piece = F.col("ending").isin(*PARTS)
    stem = F.regexp_replace("path", r"\.[^.]*$", ".shp")
    entries = lambda c: F.map_from_entries(F.sort_array(c))
    whole = told.filter(~F.coalesce(piece, F.lit(False))).select("path", entries(F.array(F.struct(F.coalesce("ending", F.lit("")).alias("k"), F.col("content").alias("v")))).alias("parts"))
    pieced = told.filter(piece).groupBy(stem.alias("path")).agg(entries(F.collect_list(F.struct(F.col("ending").alias("k"), F.col("content").alias("v")))).alias("parts"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, parts in zip(batch["path"], batch["parts"], strict=True):
                name, numbers, properties, told_rings, problem = path.as_py(), [], [], [], None
                try:
                    system, features = read(name or "", {k: v for k, v in parts.as_py() if v is not None})
                    if not (system or crs):
                        raise ValueError("no coordinate system")
                    source = from_text(system or crs or "")
                    for k, (row, rings) in enumerate(features):
                        numbers.append(k)
                        properties.append(list(row.items()))
                        told_rings.append(None if rings is None else geo._told(moved(rings, source)))
                except (ValueError, KeyError, IndexError, TypeError, LookupError, OSError, struct.error, sqlite3.Error, zipfile.BadZipFile, pa.ArrowException) as error:
                    problem = f"{type(error).__name__}: {error}"
                if problem:
                    numbers, properties, told_rings = [None], [None], [None]
                many = len(numbers)
                columns = [
                    pa.array([name] * many, pa.string()), pa.array(numbers, pa.int64()), pa.array(properties, pa.map_(pa.string(), pa.string())),
                    pa.array(told_rings, geo.RINGS_TYPE), pa.array([problem] * many, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "feature", "properties", "rings", "error"])

    return whole.unionByName(pieced).mapInArrow(work, SCHEMA)


def polygons(files: DataFrame, key: str | None = None, crs: str | None = None) -> DataFrame:
    """Polygons of vector files (path, content) in longitude and latitude.

    With a key, the union of the polygons of each of its values (key, rings, area,
    parts), else each feature's repaired polygon (path, feature, properties, rings,
    area).  A file that can't be read, and a feature without the key, stop the query.
    """
    stopped = F.raise_error(F.concat("path", F.lit(": "), "error")).cast("boolean")
    found = decode(files, crs).filter(F.when(F.col("error").isNotNull(), stopped).otherwise(True)).drop("error")
    if key is None:
        numbered = found.withColumn("_id", F.struct("path", "feature", "properties"))
        return geo.repair(numbered, "_id").select("_id.*", "rings", "area")
    lacking = F.raise_error(F.concat("path", F.lit(f" lacks the attribute {key}; it has "), F.array_join(F.map_keys("properties"), ", "))).cast("string")
    named = F.when(F.map_contains_key("properties", F.lit(key)), F.col("properties")[key]).otherwise(lacking)
    return geo.dissolve_rings(found.select(named.alias(key), F.struct("path", "feature").alias("_unit"), "rings"), key, "_unit")


def load_polygons(spark: SparkSession, path: str, key: str | None = None, crs: str | None = None) -> DataFrame:
    """``polygons`` of the vector files at a path: a file, a folder or a pattern; a .shp brings its other parts along."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(x for e in ENDINGS for x in (e, e.upper())) + "}")
    return polygons(reader.load(re.sub(r"\.shp$", ".*", path, flags=re.I)).select("path", "content"), key, crs)


def shapefile(rows: list[Feature], crs: str) -> dict[str, bytes]:
    """The parts of a shapefile of features, whose rings are given in the coordinate system."""
    records, ends = [], []
    for k, (_, rings) in enumerate(rows):
        if rings is None:
            body = struct.pack("<I", 0)
        else:
            xy = np.concatenate(rings) if rings else np.zeros((0, 2))
            box = [*xy.min(axis=0), *xy.max(axis=0)] if len(xy) else [0.0] * 4
            starts = np.cumsum([0, *map(len, rings)])[:-1]
            ends += [box] if len(xy) else []
            body = struct.pack("<I4d2I", 5, *box, len(rings), len(xy)) + starts.astype("<u4").tobytes() + xy.astype("<f8").tobytes()
        records.append(struct.pack(">II", k + 1, len(body) // 2) + body)
    all_boxes = np.array(ends or [[0.0] * 4])
    data = b"".join(records)
    head = struct.pack(">7I", 9994, 0, 0, 0, 0, 0, (100 + len(data)) // 2) + struct.pack("<2I8d", 1000, 5, *all_boxes[:, :2].min(axis=0), *all_boxes[:, 2:].max(axis=0), *[0.0] * 4)
    names = list(dict.fromkeys(n for row, _ in rows for n in row))
    texts = [[(row.get(n) or "").encode() for n in names] for row, _ in rows]
    sizes = [max([1, *(len(t[k]) for t in texts)]) for k in range(len(names))]
    if max(sizes, default=1) > 254 or any(len(n.encode()) > 10 for n in names):
        raise ValueError("a table holds names of up to 10 bytes and texts of up to 254")
    fields = b"".join(struct.pack("<11sc4xB15x", n.encode(), b"C", size) for n, size in zip(names, sizes, strict=True))
    table = struct.pack("<4BIHH20x", 3, 100, 1, 1, len(rows), 33 + len(fields), 1 + sum(sizes)) + fields + b"\r"
    table += b"".join(b" " + b"".join(v.ljust(s) for v, s in zip(t, sizes, strict=True)) for t in texts) + b"\x1a"
    return {"shp": head + data, "dbf": table, "prj": crs.encode(), "cpg": b"UTF-8"}


def encode_shapefiles(polygons: DataFrame, by: str, attributes: list[str], crs: str) -> DataFrame:
    """path and content of the parts of one shapefile for each value of ``by``, from rows (by, attributes, rings); one task makes a file."""
    target = from_text(crs)

    def work(key: tuple, table: pa.Table) -> pa.Table:
        rows: list[Feature] = []
        for row in table.sort_by([(a, "ascending") for a in attributes]).to_pylist():
            rings = [np.array([(p["x"], p["y"]) for p in ring]) for ring in row["rings"] or []]
            rows.append(({a: _text(row[a]) for a in attributes}, [np.stack(target.forward(r[:, 0], r[:, 1]), axis=1) for r in rings]))
        made = shapefile(rows, crs)
        return pa.table({"path": [f"{key[0].as_py()}.{ending}" for ending in made], "content": pa.array(list(made.values()), pa.binary())})

    return polygons.select(by, *[a for a in attributes if a != by], "rings").groupBy(by).applyInArrow(work, "path string, content binary")
