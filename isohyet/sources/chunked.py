"""Chunked array stores (Zarr, version 2) as tidy rows, with chunks picked by their keys before any is opened.

A store is a folder of arrays, each a folder of chunk files named by their places
(``0.3.1`` or ``0/3/1``) beside small JSON descriptions.  Descriptions and axes go
through the driver; their size is that of the axes.  A window of variables, box and
times becomes a range of chunk numbers on each axis and so a predicate on file
names, which prunes the list of files when the query is planned.  A chunk is read by
one task and cut by index before its values are unpacked.

Defined cases: chunks that the store lacks have no rows; fill values, NaN and
infinite values are NULL (a fill value of 0 only if the attributes name it, as 0 is
also what untold stores fill with); a broken chunk is one row with its error; compressors and
filters that are not known here raise when the store is opened.
"""

from __future__ import annotations

import bz2
import gzip
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.sources.decode import EPOCH, ROWS, SCHEMA, UNIT_SECONDS, Window, wrap

# Names of the axes in stores, and of the codecs inside blosc frames by their numbers.
AXES = {"time": "time", "lat": "lat", "latitude": "lat", "y": "lat", "lon": "lon", "longitude": "lon", "x": "lon"}
INSIDE = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
#: Rows of one record batch.
BATCH = 65_536
#: Places on an axis up to which a writer sends the axis to all tasks; longer ones are shuffled.
AXIS_ROWS = 1_000_000
KNOWN = ("zlib", "gzip", "bz2", "zstd", "lz4", "blosc")
Bounds = dict[str, tuple[int, int]]


def _whole(data: bytes, size: int, codec: str) -> bytes:
    return zlib.decompress(data) if codec == "zlib" else pa.decompress(data, decompressed_size=size, codec=codec, asbytes=True)


def blosc(data: bytes) -> bytes:
    """A blosc frame, version 1: blocks, each split by the bytes of an item or whole, with bytes of a block shuffled or not."""
    flags, width = data[2], data[3]
    size, block, _ = struct.unpack_from("<3I", data, 4)
    if flags & 2:
        return data[16 : 16 + size]
    if flags & 4 or flags >> 5 not in INSIDE:
        raise ValueError("a blosc frame with shuffled bits or an unknown codec")
    out = []
    for k in range(-(-size // block)):
        (at,) = struct.unpack_from("<i", data, 16 + 4 * k)
        length = min(block, size - k * block)
        splits = width if not flags & 16 and length == block else 1
        parts = []
        for _ in range(splits):
            (n,) = struct.unpack_from("<i", data, at)
            part = data[at + 4 : at + 4 + n]
            parts.append(part if n == length // splits else _whole(part, length // splits, INSIDE[flags >> 5]))
            at += 4 + n
        whole = b"".join(parts)
        if flags & 1 and width > 1:
            even = length - length % width
            whole = np.frombuffer(whole, np.uint8, even).reshape(width, -1).T.tobytes() + whole[even:]
        out.append(whole)
    return b"".join(out)


@dataclass(frozen=True)
class Array:
    """One array of a store by its descriptions."""

    shape: tuple[int, ...]
    chunks: tuple[int, ...]
    dtype: str
    order: str
    fill: object
    compressor: dict[str, object] | None
    dims: tuple[str, ...]
    attributes: dict[str, object]

    @staticmethod
    def of(told: dict, attributes: dict) -> Array:
        codec = told.get("compressor")
        if told.get("zarr_format") != 2 or told.get("filters") or codec and codec["id"] not in KNOWN:
            raise ValueError(f"an array of version {told.get('zarr_format')} with filters {told.get('filters')} and compressor {codec}")
        return Array(tuple(told["shape"]), tuple(told["chunks"]), told["dtype"], told.get("order", "C"), told.get("fill_value"), codec, tuple(attributes.get("_ARRAY_DIMENSIONS", ())), attributes)

    def unpack(self, data: bytes) -> np.ndarray:
        """The values of a chunk as stored, in its full shape."""
        codec, size = (self.compressor or {}).get("id"), int(np.prod(self.chunks)) * np.dtype(self.dtype).itemsize
        if codec == "blosc":
            data = blosc(data)
        elif codec == "lz4":
            data = _whole(data[4:], struct.unpack_from("<I", data)[0], "lz4_raw")
        elif codec in ("gzip", "bz2"):
            data = {"gzip": gzip, "bz2": bz2}[codec].decompress(data)
        elif codec:
            data = _whole(data, size, codec)
        return np.frombuffer(data, self.dtype).reshape(self.chunks, order=self.order)

    def values(self, raw: np.ndarray) -> np.ndarray:
        """Values by scale and offset; missing ones are NaN."""
        made = raw.astype(float)
        named = [self.attributes.get("_FillValue"), self.attributes.get("missing_value"), self.fill or None]
        fills = [float(f) for f in named if isinstance(f, int | float)]
        made[np.isin(made, fills) | ~np.isfinite(made)] = np.nan
        return made * float(self.attributes.get("scale_factor", 1.0)) + float(self.attributes.get("add_offset", 0.0))


@dataclass(frozen=True)
class Store:
    """The grids of a store, by name, and their axes: times in microseconds, latitudes, longitudes from -180 to 180."""

    grids: dict[str, Array]
    axes: dict[str, np.ndarray]

    def wanted(self, window: Window) -> dict[str, np.ndarray]:
        """Places on each axis that the window holds."""
        times = self.axes["time"]
        micros = lambda at, other: other if at is None else (at - EPOCH) // timedelta(microseconds=1)
        held = np.flatnonzero((times >= micros(window.start, times.min(initial=0))) & (times < micros(window.end, times.max(initial=0) + 1)))
        return {"time": held, "lat": window.inside(self.axes["lat"], "lat"), "lon": window.inside(self.axes["lon"], "lon")}

    def picked(self, path: Column, window: Window) -> Column:
        """Whether a path is that of a chunk with wanted values."""
        places, found = self.wanted(window), F.lit(False)
        for name, grid in self.grids.items():
            if not window.wants(name):
                continue
            key = F.split(F.regexp_extract(path, rf"/{re.escape(name)}/([0-9]+(?:[./][0-9]+)*)$", 1), "[./]")
            mine = F.size(key) == len(grid.shape)
            for k, (dim, long) in enumerate(zip(grid.dims, grid.chunks, strict=True)):
                numbers = [int(c) for c in np.unique(places[AXES[dim]] // long)]
                at = F.get(key, F.lit(k)).try_cast("int")
                # places in a window are neighbours as a rule, so that two bounds tell them; a store that is not in order needs the list
                whole = numbers and numbers[-1] - numbers[0] + 1 == len(numbers)
                mine &= at.between(numbers[0], numbers[-1]) if whole else at.isin(numbers)
            found |= F.coalesce(mine, F.lit(False))
        return found

    def rows(self, chunks: DataFrame, window: Window | None = None, drop_missing: bool = False) -> DataFrame:
        """path, variable, time, lat, lon, value and error of chunks (path, content); missing values are NULL, or left out on request."""
        asked, store = window or Window(), self
        places = self.wanted(asked)

        def one(path: str, content: bytes) -> Iterator[pa.RecordBatch]:
            name, key = re.search(r"/([^/]+)/([0-9]+(?:[./][0-9]+)*)$", path).groups()
            grid = store.grids[name]
            raw, cut, where = grid.unpack(content), [], {}
            for number, dim, long in zip(re.split("[./]", key), grid.dims, grid.chunks, strict=True):
                first = int(number) * long
                mine = places[AXES[dim]]
                where[AXES[dim]] = mine[(mine >= first) & (mine < first + long)]
                cut.append(where[AXES[dim]] - first)
            values = grid.values(raw[np.ix_(*cut)]).transpose([[AXES[d] for d in grid.dims].index(a) for a in ("time", "lat", "lon")])
            keep = np.flatnonzero(~np.isnan(values)) if drop_missing else np.arange(values.size)
            for at in range(0, len(keep), BATCH):
                mine = keep[at : at + BATCH]
                t, i, j = np.unravel_index(mine, values.shape)
                told = values.ravel()[mine]
                axis = lambda a, k: store.axes[a][where[a]][k]
                columns = [
                    pa.array([name]).take(pa.array(np.zeros(len(mine), np.int32))), pa.array(axis("time", t).astype(np.int64)).cast(pa.timestamp("us")),
                    pa.array(axis("lat", i).astype(float)), pa.array(axis("lon", j).astype(float)), pa.array(told, mask=np.isnan(told)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=ROWS)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                    try:
                        for made in one(path, content.as_py()):
                            yield pa.RecordBatch.from_arrays([pa.array([path] * made.num_rows), *made.columns, pa.nulls(made.num_rows, pa.string())], names=["path", *ROWS.names, "error"])
                    except (ValueError, KeyError, IndexError, TypeError, AttributeError, OSError, EOFError, struct.error, zlib.error, pa.ArrowException) as error:
                        yield pa.RecordBatch.from_arrays([pa.array([path]), *[pa.nulls(1, t) for t in ROWS.types], pa.array([f"{type(error).__name__}: {error}"])], names=["path", *ROWS.names, "error"])

        return chunks.filter(self.picked(F.col("path"), asked)).select("path", "content").mapInArrow(work, SCHEMA)


def described(told: dict[str, dict], chunk: dict[str, dict[str, bytes]]) -> Store:
    """A store from its descriptions (as in the consolidated one) and the chunks of its axes by array and key."""
    arrays = {k.removesuffix("/.zarray"): Array.of(v, told.get(k.removesuffix(".zarray") + ".zattrs", {})) for k, v in told.items() if k.endswith("/.zarray")}
    axes: dict[str, np.ndarray] = {}
    for name, array in arrays.items():
        if name not in AXES or len(array.shape) != 1:
            continue
        parts = [array.unpack(chunk[name][str(k)]) for k in range(-(-array.shape[0] // array.chunks[0]))]
        values = np.concatenate(parts)[: array.shape[0]] if parts else np.zeros(0)
        if AXES[name] == "time":
            unit, since = re.fullmatch(r"(\w+?)s? since (.+)", str(array.attributes["units"])).groups()
            start = (datetime.fromisoformat(since.strip().replace(" UTC", "").rstrip("Z")) - EPOCH) // timedelta(microseconds=1)
            values = start + np.round(values.astype(float) * UNIT_SECONDS[unit] * 1e6).astype(np.int64)
        axes[AXES[name]] = wrap(values.astype(float)) if AXES[name] == "lon" else values
    grids = {n: a for n, a in arrays.items() if len(a.dims) == 3 and {AXES.get(d) for d in a.dims} == {"time", "lat", "lon"}}
    if set(axes) != {"time", "lat", "lon"}:
        raise ValueError("a store needs the axes time, lat and lon")
    return Store(grids, axes)


def _json(spark: SparkSession, path: str) -> dict:
    """A small file whose name starts with a dot, which Spark's readers pass over."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def open_store(spark: SparkSession, path: str) -> Store:
    """The store of a folder with a consolidated description."""
    told = _json(spark, f"{path}/.zmetadata")["metadata"]
    names = [n for n in AXES if f"{n}/.zarray" in told]
    chunk: dict[str, dict[str, bytes]] = {}
    for n in names:
        found = spark.read.format("binaryFile").load(f"{path}/{n}").select("path", "content")
        chunk[n] = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in found.collect()}
    return described(told, chunk)


def read_store(spark: SparkSession, path: str, window: Window | None = None, drop_missing: bool = False) -> DataFrame:
    """Tidy rows of a store's window; chunks outside are not opened."""
    store = open_store(spark, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return store.rows(files.filter(store.picked(F.col("_metadata.file_path"), window or Window())).select("path", "content"), window, drop_missing)


def encode_store(rows: DataFrame, values: list[str], chunks: tuple[int, int, int]) -> tuple[Store, DataFrame]:
    """A store and its chunks (path, content) from rows (time, lat, lon, values); its axes are the distinct times and places.

    One task makes a chunk.  Of rows at one time and place the greatest values
    stay; cells without a row hold NaN, and chunks without any row are not written.
    """
    spark, numbered, axes = rows.sparkSession, rows, {}
    for name in ("time", "lat", "lon"):
        found = sorted(r[0] for r in rows.filter(F.col(name).isNotNull()).select(name).distinct().collect())
        axes[name] = found
        places = spark.createDataFrame(list(enumerate(found)), f"_{name} int, {name} {dict(rows.dtypes)[name]}")
        numbered = numbered.join(F.broadcast(places) if len(found) <= AXIS_ROWS else places, name)
    shape = tuple(len(axes[n]) for n in ("time", "lat", "lon"))
    grid = Array(shape, chunks, "<f8", "C", None, {"id": "zlib"}, ("time", "lat", "lon"), {})
    micros = np.array([(t - EPOCH) // timedelta(microseconds=1) for t in axes["time"]], np.int64)
    store = Store({v: grid for v in values}, {"time": micros, "lat": np.array(axes["lat"], float), "lon": np.array(axes["lon"], float)})

    def work(key: tuple, table: pa.Table) -> pa.Table:
        first = [k.as_py() for k in key]
        at = tuple(table[f"_{n}"].to_numpy() - f * c for n, f, c in zip(("time", "lat", "lon"), first, chunks, strict=True))
        paths, contents = [], []
        for v in values:
            full = np.full(chunks, np.nan)
            np.fmax.at(full, at, table[v].cast(pa.float64()).to_numpy())
            paths.append(f"/{v}/" + ".".join(map(str, first)))
            contents.append(zlib.compress(full.tobytes(), 1))
        return pa.table({"path": paths, "content": pa.array(contents, pa.binary())})

    keys = [F.floor(F.col(f"_{n}") / c).cast("int").alias(f"_c{n}") for n, c in zip(("time", "lat", "lon"), chunks, strict=True)]
    made = numbered.select(*keys, "_time", "_lat", "_lon", *values).groupBy("_ctime", "_clat", "_clon").applyInArrow(work, "path string, content binary")
    return store, made
