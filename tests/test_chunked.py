"""Chunked stores: every compressor, windows, pruned file lists, scales and fills, and errors."""

import bz2
import gzip
import json
import struct
import zlib
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest

from isohyet.operators.spatial import BoundingBox
from isohyet.sources import chunked
from isohyet.sources.decode import Window

START = datetime(2024, 1, 1)
TIMES, LAT, LON = np.arange(50), 44.0 + 0.5 * np.arange(7), 265.0 + 0.5 * np.arange(11)
CHUNKS = (24, 3, 4)


def shuffled(raw, width):
    return np.frombuffer(raw, np.uint8).reshape(-1, width).T.tobytes()


def blosc_frame(raw, width, block, codec, split, shuffle):
    """A frame as the format's description has it; blocks that don't shrink are stored."""
    name = chunked.INSIDE[codec]
    pack = zlib.compress if name == "zlib" else lambda b: pa.compress(b, codec=name, asbytes=True)
    blocks = []
    for at in range(0, len(raw), block):
        part = raw[at : at + block]
        full = len(part) == block
        part = shuffled(part, width) if shuffle else part
        n = width if split and full else 1
        made = b""
        for k in range(n):
            piece = part[k * len(part) // n : (k + 1) * len(part) // n]
            small = pack(piece)
            small = small if len(small) < len(piece) else piece
            made += struct.pack("<i", len(small)) + small
        blocks.append(made)
    starts = np.cumsum([16 + 4 * len(blocks), *map(len, blocks)])
    flags = shuffle | (0 if split else 16) | codec << 5
    return struct.pack("<4B3I", 2, 1, flags, width, len(raw), block, int(starts[-1])) + starts[:-1].astype("<i4").tobytes() + b"".join(blocks)


PACK = {
    None: lambda b: b, "zlib": zlib.compress, "gzip": gzip.compress, "bz2": bz2.compress, "zstd": lambda b: pa.compress(b, codec="zstd", asbytes=True),
    "lz4": lambda b: struct.pack("<I", len(b)) + pa.compress(b, codec="lz4_raw", asbytes=True), "blosc": lambda b: blosc_frame(b, 2, 256, 1, True, 1),
}


def write(folder, codec="zlib", separator=".", order="C"):
    """A store with the grid t (scaled shorts, dims time, lat, lon) and p (floats, dims lat, lon, time)."""
    rng = np.random.default_rng(5)
    t = rng.integers(-300, 300, (len(TIMES), len(LAT), len(LON))).astype("<i2")
    t[3, 2, 1] = -9999
    p = rng.random((len(LAT), len(LON), len(TIMES))).astype("<f4")
    p[0, 0, 0] = np.nan
    meta = {}

    def array(name, values, chunks, dims, attributes, fill, codec=codec):
        meta[f"{name}/.zarray"] = {
            "zarr_format": 2, "shape": list(values.shape), "chunks": list(chunks), "dtype": values.dtype.str, "order": order, "fill_value": fill, "filters": None,
            "compressor": {"id": codec} if codec else None, "dimension_separator": separator,
        }
        meta[f"{name}/.zattrs"] = {"_ARRAY_DIMENSIONS": list(dims), **attributes}
        for place in np.ndindex(*[-(-s // c) for s, c in zip(values.shape, chunks, strict=True)]):
            full = np.zeros(chunks, values.dtype)
            part = values[tuple(slice(k * c, (k + 1) * c) for k, c in zip(place, chunks, strict=True))]
            full[tuple(slice(0, n) for n in part.shape)] = part
            at = folder / name / separator.join(map(str, place))
            at.parent.mkdir(parents=True, exist_ok=True)
            at.write_bytes(PACK[codec](full.tobytes(order)))

    array("time", TIMES.astype("<i8"), (20,), ["time"], {"units": "hours since 2024-01-01 00:00:00"}, None, "zlib")
    array("latitude", LAT.astype("<f8"), (7,), ["latitude"], {}, None, None)
    array("longitude", LON.astype("<f8"), (5,), ["longitude"], {}, None, None)
    array("t", t, CHUNKS, ["time", "latitude", "longitude"], {"scale_factor": 0.1, "add_offset": 5.0}, -9999)
    array("p", p, (3, 4, 24), ["latitude", "longitude", "time"], {}, "NaN")
    (folder / ".zmetadata").write_text(json.dumps({"zarr_consolidated_format": 1, "metadata": meta}))
    scaled = np.where(t == -9999, np.nan, t * 0.1 + 5.0)
    return {"t": scaled, "p": p.transpose(2, 0, 1).astype(float)}


def want(grids, variables=("t", "p"), box=None, start=0, end=50):
    made = {}
    for v in variables:
        for k, i, j in np.ndindex(*grids[v].shape):
            lat, lon = LAT[i], LON[j] - 360
            if start <= k < end and (box is None or box.south <= lat <= box.north and box.west <= lon <= box.east):
                x = grids[v][k, i, j]
                made[v, START + timedelta(hours=k), lat, lon] = None if np.isnan(x) else pytest.approx(x)
    return made


def told(rows):
    rows = rows.collect()
    assert all(r.error is None for r in rows)
    made = {(r.variable, r.time, r.lat, r.lon): r.value for r in rows}
    assert len(made) == len(rows)
    return made


@pytest.mark.parametrize("codec,separator,order", [(None, ".", "C"), ("zlib", "/", "F"), ("gzip", ".", "C"), ("bz2", ".", "F"), ("zstd", ".", "C"), ("lz4", "/", "C"), ("blosc", ".", "C")])
def test_stores(spark, tmp_path, codec, separator, order):
    grids = write(tmp_path, codec, separator, order)
    assert told(chunked.read_store(spark, str(tmp_path))) == want(grids)


@pytest.mark.parametrize("codec", chunked.INSIDE)
@pytest.mark.parametrize("split,shuffle", [(True, 1), (False, 1), (False, 0), (True, 0)])
def test_frames(codec, split, shuffle):
    raw = np.repeat(np.arange(1000, dtype="<i4"), 3).tobytes()
    assert chunked.blosc(blosc_frame(raw, 4, 4096, codec, split, shuffle)) == raw
    assert chunked.blosc(struct.pack("<4B3I", 2, 1, 2, 4, len(raw), 4096, len(raw) + 16) + raw) == raw


def iter_scans(node):
    if node.nodeName().startswith(("Scan", "FileScan")):
        yield node
    for k in range(node.children().size()):
        yield from iter_scans(node.children().apply(k))


def test_fills_and_empty_tables(spark):
    told = {"zarr_format": 2, "shape": [1], "chunks": [1], "dtype": "<f8", "compressor": None}
    raw = np.array([0.0, 7.0, np.inf, 1.0])
    for fill, attributes, missing in ((0, {}, [2]), (7, {}, [1, 2]), (None, {"_FillValue": 0}, [0, 2]), (0, {"_FillValue": 0, "missing_value": 7.0}, [0, 1, 2])):
        got = chunked.Array.of({**told, "fill_value": fill}, attributes).values(raw)
        assert np.flatnonzero(np.isnan(got)).tolist() == missing
    kind = "time timestamp_ntz, lat double, lon double, v double"
    store, chunks = chunked.encode_store(spark.createDataFrame([], kind), ["v"], (2, 2, 2))
    assert store.rows(chunks).count() == 0
    rows = [(START, 1.0, 2.0, 3.0), (START, 1.0, 2.0, 5.0), (START, 1.5, 2.0, None), (START + timedelta(hours=1), 9.0, -4.0, 1.0), (None, 1.0, 1.0, 1.0)]
    store, chunks = chunked.encode_store(spark.createDataFrame(rows, kind), ["v"], (2, 2, 2))
    got = {(r.time, r.lat, r.lon): r.value for r in store.rows(chunks, drop_missing=True).collect()}
    assert got == {(START, 1.0, 2.0): 5.0, (START + timedelta(hours=1), 9.0, -4.0): 1.0}


def test_windows_open_their_chunks_alone(spark, tmp_path):
    grids = write(tmp_path)
    box = BoundingBox(-94.2, 44.4, -93.4, 45.1)
    window = Window(("t",), box, START + timedelta(hours=20), START + timedelta(hours=30))
    rows = chunked.read_store(spark, str(tmp_path), window)
    assert told(rows) == want(grids, ("t",), box, 20, 30)
    store = chunked.open_store(spark, str(tmp_path))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert sorted(r[0].rsplit("/", 2)[1:] for r in files.filter(store.picked(chunked.F.col("path"), window)).select("path").collect()) == [["t", "0.0.0"], ["t", "1.0.0"]]
    scanned = files.filter(store.picked(chunked.F.col("_metadata.file_path"), window)).select("path", "content")
    assert len(scanned.collect()) == 2
    scan = next(iter_scans(scanned._jdf.queryExecution().executedPlan()))
    assert scan.metrics().apply("numFiles").value() == 2
    # other chunks may be broken: they are not opened
    for at in tmp_path.glob("[pt]/*"):
        if not (at.parent.name == "t" and at.name in ("0.0.0", "1.0.0")):
            at.write_bytes(b"broken")
    assert told(chunked.read_store(spark, str(tmp_path), window)) == want(grids, ("t",), box, 20, 30)
    bad = chunked.read_store(spark, str(tmp_path), Window(("p",))).collect()
    assert len(bad) == 3 * 3 * 3 and all(r.error and r.value is None for r in bad)
    (tmp_path / "t" / "1.0.0").unlink()
    assert told(chunked.read_store(spark, str(tmp_path), window)) == want(grids, ("t",), box, 20, 24)
    assert chunked.read_store(spark, str(tmp_path), Window(("t",), BoundingBox(0, 0, 1, 1))).count() == 0
    assert chunked.read_store(spark, str(tmp_path), Window(("none",))).count() == 0


def test_unknown_parts_raise(spark, tmp_path):
    write(tmp_path)
    at = tmp_path / ".zmetadata"
    meta = at.read_text()
    for old, new in (('"filters": null', '"filters": [{"id": "delta"}]'), ('"id": "zlib"', '"id": "own"'), ('"zarr_format": 2', '"zarr_format": 3')):
        at.write_text(meta.replace(old, new))
        with pytest.raises(ValueError):
            chunked.open_store(spark, str(tmp_path))
