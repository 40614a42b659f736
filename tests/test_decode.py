"""Binary grids: files are made here by the published layouts, and their arrays are read back."""

import gzip
import io
import os
import struct
import zipfile
import zlib
from datetime import date, datetime

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from isohyet.operators.spatial import BoundingBox
from isohyet.sources import datasource, decode
from isohyet.sources import gridded as sources
from isohyet.sources.decode import Window

LAT, LON = np.array([45.0, 44.5, 44.0]), np.array([-97.0, -96.5, -96.0, -95.5])


def nc(day=0, scale=None, **more):
    """Two hours of two variables; day counts from 2024-01-01."""
    values = np.arange(24, dtype=np.float64).reshape(2, 3, 4) + 100 * day
    told = {"_FillValue": np.float64(-9999.0)}
    values[0, 0, 0] = -9999.0
    made = {
        "time": (("time",), np.array([0, 1], np.int32), {"units": f"hours since 2024-01-{day + 1:02d} 00:00:00"}),
        "lat": (("lat",), LAT, {}), "lon": (("lon",), LON, {}),
        "air": (("time", "lat", "lon"), values, told),
        "rain": (("time", "lat", "lon"), np.arange(24, dtype=np.int16).reshape(2, 3, 4), {"scale_factor": np.float32(0.5), "add_offset": np.float32(10.0), "_FillValue": np.int16(3)}),
    }
    return decode.encode_netcdf({"time": None, "lat": 3, "lon": 4}, made | more)


def table(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


def test_netcdf_round_trip():
    rows = table(decode.netcdf_rows(nc(), Window()))
    air = [r for r in rows if r[0] == "air"]
    assert len(rows) == 48 and len(air) == 24
    assert air[0] == ("air", datetime(2024, 1, 1), 45.0, -97.0, None) and air[-1] == ("air", datetime(2024, 1, 1, 1), 44.0, -95.5, 23.0)
    rain = [r[4] for r in rows if r[0] == "rain"]
    assert rain == [None if k == 3 else 10 + k / 2 for k in range(24)]


def test_netcdf_window():
    box = BoundingBox(-96.6, 44.4, -95.9, 44.6)
    rows = table(decode.netcdf_rows(nc(), Window(("air",), box, datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 2))))
    assert rows == [("air", datetime(2024, 1, 1, 1), 44.5, -96.5, 17.0), ("air", datetime(2024, 1, 1, 1), 44.5, -96.0, 18.0)]
    assert table(decode.netcdf_rows(nc(), Window(box=BoundingBox(0, 0, 1, 1)))) == []


def test_netcdf_versions_and_streams():
    """32-bit offsets, 64-bit sizes, a streamed number of records, and one record variable without padding, written by hand."""
    name = lambda s: struct.pack(">I", len(s)) + s + b"\0" * (-len(s) % 4)
    head = lambda records, begin: b"CDF\x01" + records + struct.pack(">II", 10, 1) + name(b"t") + struct.pack(">I", 0) + bytes(8) + struct.pack(">II", 11, 1) + name(b"v") + struct.pack(">II", 1, 0) + bytes(8) + struct.pack(">III", 3, 4, begin)
    for records in (struct.pack(">I", 3), b"\xff" * 4):
        data = struct.pack(">hhh", 5, -6, 7)
        file = decode.NetCDF(head(records, len(head(records, 0))) + data)
        assert file.raw("v").tolist() == [5, -6, 7]
    name5 = lambda s: struct.pack(">Q", len(s)) + s + b"\0" * (-len(s) % 4)
    head5 = lambda begin: b"CDF\x05" + struct.pack(">Q", 0) + struct.pack(">IQ", 10, 1) + name5(b"x") + struct.pack(">Q", 2) + struct.pack(">IQ", 0, 0) + struct.pack(">IQ", 11, 1) + name5(b"v") + struct.pack(">QQ", 1, 0) + struct.pack(">IQ", 0, 0) + struct.pack(">IQQ", 10, 16, begin)
    assert decode.NetCDF(head5(len(head5(0))) + struct.pack(">qq", 1 << 40, -1)).raw("v").tolist() == [1 << 40, -1]


def test_netcdf_curvilinear():
    lat, lon = np.array([[40.0, 40.5], [41.0, 41.5]]), np.array([[260.0, 261.0], [260.5, 261.5]])
    made = {
        "time": (("time",), np.array([0.5]), {"units": "days since 2000-02-28"}), "lat": (("y", "x"), lat, {}), "lon": (("y", "x"), lon, {}),
        "air": (("time", "y", "x"), np.array([[[1, 2], [3, 4]]], np.float32), {}),
    }
    content = decode.encode_netcdf({"time": None, "y": 2, "x": 2}, made)
    assert table(decode.netcdf_rows(content, Window()))[0] == ("air", datetime(2000, 2, 28, 12), 40.0, -100.0, 1.0)
    assert [r[2:] for r in table(decode.netcdf_rows(content, Window(box=BoundingBox(-99.8, 40.6, -99.2, 42))))] == [(41.0, -99.5, 3.0)]


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=80), st.integers(0, 2000))
def test_broken_netcdf_is_an_error_or_rows(noise, cut):
    whole = nc()
    for content in (whole[:cut], whole[: cut % len(whole)] + noise + whole[cut % len(whole) + len(noise) :]):
        try:
            table(decode.any_rows("x", content, Window()))
        except (ValueError, KeyError, IndexError, OverflowError, EOFError, OSError, struct.error, zlib.error):
            pass


def tiff(values, how=1, predictor=1, order="<", tile=None, rows=2, nodata=b"-9999\0", samples=1):
    """A raster of 0.5 degree pixels whose corner is (-97.25, 45.25)."""
    height, width = values.shape
    kind = values.dtype.newbyteorder(order)
    blocks, (high, wide) = [], tile or (rows, width)
    for i in range(0, height, high):
        for j in range(0, width, wide):
            part = values[i : i + high, j : j + wide]
            if tile:
                part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1])))
            part = part.astype(kind)
            if predictor == 2:
                part = np.concatenate([part[:, :1], np.diff(part.astype(part.dtype.newbyteorder("=")), axis=1)], axis=1).astype(kind)
            raw = part.tobytes()
            if predictor == 3:
                planes = part.astype(part.dtype.newbyteorder(">")).view(np.uint8).reshape(*part.shape, -1).transpose(0, 2, 1).reshape(part.shape[0], -1)
                raw = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], axis=1).astype(np.uint8).tobytes()
            blocks.append(zlib.compress(raw) if how == 8 else packed_lzw(raw) if how == 5 else raw)
    fields = [
        (256, "I", [width]), (257, "I", [height]), (258, "H", [values.dtype.itemsize * 8]), (259, "H", [how]), (277, "H", [samples]), (317, "H", [predictor]),
        (339, "H", [{"u": 1, "i": 2, "f": 3}[values.dtype.kind]]), (33550, "d", [0.5, 0.5, 0.0]), (33922, "d", [0, 0, 0, -97.25, 45.25, 0]), (42113, "s", [nodata]),
    ]
    sizes = [len(b) for b in blocks]
    fields += [(322, "I", [wide]), (323, "I", [high]), (324, "I", None), (325, "I", sizes)] if tile else [(278, "I", [rows]), (273, "I", None), (279, "I", sizes)]
    codes = {"s": 2, "H": 3, "I": 4, "d": 12}
    fields.sort()
    start = 8 + 2 + 12 * len(fields) + 4
    extra, entries = b"", b""
    at = lambda: start + len(extra)
    room = sum(len(f[2]) * struct.calcsize(f[1]) if f[1] != "s" else len(nodata) for f in fields if f[2]) + 4 * len(blocks) * 2 + 64
    begins = list(np.cumsum([start + room, *sizes[:-1]]))
    for tag, code, held in fields:
        held = begins if held is None else held
        raw = held[0] if code == "s" else struct.pack(f"{order}{len(held)}{code}", *held)
        many = len(raw) if code == "s" else len(held)
        place = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(f"{order}I", at())
        extra += raw if len(raw) > 4 else b""
        entries += struct.pack(f"{order}HHI", tag, codes[code], many) + place
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 8) + struct.pack(f"{order}H", len(fields)) + entries + bytes(4)
    return (head + extra).ljust(start + room, b"\0") + b"".join(blocks)


def packed_lzw(raw):
    """LZW by the published scheme: clear first, widths grow one code early, clear again before 12 bits run out."""
    out, width, table, bits = [], 9, {bytes([k]): k for k in range(256)}, ""
    put = lambda code: out.append(f"{code:0{width}b}")
    put(256)
    held, following = b"", 258
    for byte in raw:
        new = held + bytes([byte])
        if new in table:
            held = new
            continue
        put(table[held])
        table[new] = following
        following += 1
        held = bytes([byte])
        if following + 1 > (1 << width) and width < 12:
            width += 1
        if following >= 4094:
            put(256)
            table, following, width = {bytes([k]): k for k in range(256)}, 258, 9
    if held:
        put(table[held])
        following += 1
        if following + 1 > (1 << width) and width < 12:
            width += 1
    put(257)
    bits = "".join(out)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


GRID = np.arange(35).reshape(5, 7)


@pytest.mark.parametrize("how", [1, 5, 8])
@pytest.mark.parametrize("predictor", [1, 2, 3])
@pytest.mark.parametrize("kind", ["u1", "i2", "f4", "f8"])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("tile", [None, (2, 3)])
def test_geotiff_round_trip(how, predictor, kind, order, tile):
    if (predictor == 3) != (kind[0] == "f") and predictor != 1:
        return
    image = decode.GeoTiff(tiff(GRID.astype(kind), how, predictor, order, tile))
    assert image.window(np.arange(5), np.arange(7)).tolist() == GRID.tolist()
    assert image.lat[:2].tolist() == [45.0, 44.5] and image.lon[:2].tolist() == [-97.0, -96.5]
    assert image.window(np.array([1, 4]), np.array([2, 6])).tolist() == [[9, 13], [30, 34]]


def test_geotiff_window_unpacks_only_its_blocks():
    """Strips outside the box may be rubbish."""
    content = bytearray(tiff(GRID.astype("f4"), 8, rows=1))
    image = decode.GeoTiff(bytes(content))
    for k in (0, 1, 4):
        content[image.offsets[k] : image.offsets[k] + image.counts[k]] = b"\1" * image.counts[k]
    rows = table(decode.geotiff_rows(bytes(content), "ppt", datetime(2024, 1, 2), Window(box=BoundingBox(-96.1, 43.4, -95.4, 44.1))))
    assert rows == [("ppt", datetime(2024, 1, 2), lat, lon, float(v)) for lat, lon, v in ((44.0, -96.0, 16), (44.0, -95.5, 17), (43.5, -96.0, 23), (43.5, -95.5, 24))]
    with pytest.raises(zlib.error):
        table(decode.geotiff_rows(bytes(content), "ppt", datetime(2024, 1, 2), Window()))


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(1, 60))
def test_lzw(raw, times):
    assert decode.lzw(packed_lzw(raw * times)) == raw * times


def grib(values, bits=12, two=-1, ten=1, mode=0x00, bitmap=None, hour=5, discipline=209, numbers=(6, 1), template=0, lats=(45.0, 44.0), lons=(263.0, 264.5), image=None):
    """One message on a regular grid; rows of values stand from the first latitude on."""
    rows, columns = values.shape
    sign = lambda v, n: (1 << (n - 1)) | -v if v < 0 else v
    field = values.T if mode & 0x20 else values
    if mode & 0x10:
        field = np.where((np.arange(field.shape[0]) % 2 == 1)[:, None], field[:, ::-1], field)
    flat = field.ravel()
    kept = flat if bitmap is None else flat[np.asarray(bitmap, bool)]
    level = float(kept.min()) * 10.0**ten if len(kept) else 0.0
    level = struct.unpack(">f", struct.pack(">f", level))[0]
    codes = np.round((kept * 10.0**ten - level) / 2.0**two).astype(int)
    data = int("".join(f"{c:0{bits}b}" for c in codes).ljust(-(-bits * len(codes) // 8) * 8, "0") or "0", 2).to_bytes(-(-bits * len(codes) // 8), "big") if bits else b""
    data = image(codes) if image else data
    part = lambda n, body: struct.pack(">IB", 5 + len(body), n) + body
    micro = lambda x: sign(round(x * 1e6), 32)
    one = part(1, struct.pack(">HHBBBHBBBBBBB", 7, 0, 2, 1, 1, 2024, 1, 2, hour, 0, 0, 0, 1))
    three = part(3, struct.pack(">BIBBH", 0, rows * columns, 0, 0, 0) + struct.pack(">BBIBIBI", 6, 0, 0, 0, 0, 0, 0) + struct.pack(">IIII", columns, rows, 0, 0) + struct.pack(">IIBIIIIB", micro(lats[0]), micro(lons[0]), 48, micro(lats[1]), micro(lons[1]), 0, 0, mode))
    four = part(4, struct.pack(">HH", 0, 0) + bytes([*numbers]) + struct.pack(">BBBHBBI", 2, 0, 0, 0, 0, 1, 3))
    five = part(5, struct.pack(">IHfHHBB", len(kept), template, level, sign(two, 16), sign(ten, 16), bits, 0))
    six = part(6, b"\xff" if bitmap is None else b"\0" + np.packbits(np.asarray(bitmap, np.uint8)).tobytes())
    body = one + three + four + five + six + part(7, data) + b"7777"
    return b"GRIB\0\0" + bytes([discipline, 2]) + struct.pack(">Q", 16 + len(body)) + body


@pytest.mark.parametrize("bits", [8, 11, 16])
@pytest.mark.parametrize("mode", [0x00, 0x20, 0x10])
def test_grib2_round_trip(bits, mode):
    values = np.arange(12).reshape(3, 4) * 0.5
    rows = table(decode.grib2_rows(grib(values, bits, two=0, ten=1, mode=mode), Window()))
    assert [r[4] for r in rows] == pytest.approx(values.ravel().tolist())
    assert rows[0][:4] == ("unknown", datetime(2024, 1, 2, 8), 45.0, -97.0) and rows[-1][2:4] == (44.0, -95.5)


def test_grib2_bitmap_constant_many_and_errors():
    values = np.arange(12).reshape(3, 4).astype(float)
    rows = table(decode.grib2_rows(grib(values, bitmap=[k % 3 > 0 for k in range(12)]) + grib(np.full((3, 4), 7.0), bits=0, discipline=0, numbers=(1, 8)), Window()))
    assert [r[4] for r in rows[:12]] == [float(k) if k % 3 else None for k in range(12)]
    assert {(r[0], r[4]) for r in rows[12:]} == {("tp", 7.0)}
    assert {r[0] for r in table(decode.grib2_rows(grib(values) + grib(values, discipline=0, numbers=(1, 8)), Window(("tp",), BoundingBox(-96.6, 44.4, -96.4, 44.6))))} == {"tp"}
    for broken in (grib(values)[:-10], grib(values, template=40), b"GRIB\0\0\0\1" + bytes(20)):
        with pytest.raises(ValueError):
            table(decode.grib2_rows(broken, Window()))


def png(values, depth, how):
    """A grey, three-byte (24) or four-byte (32) PNG whose lines all take one filter."""
    height, width = values.shape
    near = max(1, depth // 8)
    if depth < 8:
        bits = ((values[:, :, None] >> np.arange(depth)[::-1]) & 1).astype(np.uint8).reshape(height, -1)
        lines = np.packbits(bits, axis=1)
    else:
        lines = ((values[:, :, None] >> (8 * np.arange(near)[::-1])) & 255).astype(np.uint8).reshape(height, -1)
    out = b""
    for k, line in enumerate(lines.astype(int)):
        up = lines[k - 1].astype(int) if k else np.zeros_like(line)
        left, corner = (np.concatenate([np.zeros(near, int), x[:-near]]) for x in (line, up))
        plane = left + up - corner
        apart = np.abs(np.stack([plane - left, plane - up, plane - corner]))
        paeth = np.choose(apart.argmin(axis=0), [left, up, corner])
        out += bytes([how]) + ((line - [0, left, up, (left + up) // 2, paeth][how]) & 255).astype(np.uint8).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, min(depth, 16) if depth <= 16 else 8, {24: 2, 32: 6}.get(depth, 0), 0, 0, 0)
    packed = zlib.compress(out)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", packed[:7]) + part(b"IDAT", packed[7:]) + part(b"IEND", b"")


@pytest.mark.parametrize("depth", [1, 4, 8, 16, 24, 32])
@pytest.mark.parametrize("how", range(5))
def test_png(depth, how):
    values = np.random.default_rng(depth + how).integers(0, 1 << depth, (6, 13))
    assert decode.png_values(png(values, depth, how)).tolist() == values.ravel().tolist()


@pytest.mark.parametrize("how", [0, 4])
def test_grib2_png(how):
    values = np.arange(12).reshape(3, 4) * 0.5
    content = grib(values, 16, two=0, ten=1, template=41, image=lambda codes: png(codes.reshape(3, 4), 16, how))
    assert [r[4] for r in table(decode.grib2_rows(content, Window()))] == pytest.approx(values.ravel().tolist())
    with pytest.raises(ValueError):
        table(decode.grib2_rows(grib(values, 16, template=41), Window()))


def archive(name, content):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr(name, content)
        z.writestr("notes.txt", "x")
    return held.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Five days of NetCDF, a zipped raster, a gzipped radar field and three files that are broken."""
    path = tmp_path_factory.mktemp("granules")
    for day in range(5):
        (path / f"grid_2024010{day + 1}.nc").write_bytes(nc(day))
    (path / "prism_ppt_4km_20240102.zip").write_bytes(archive("prism_ppt_us_25m_20240102.tif", tiff(GRID.astype("f4"), 8)))
    (path / "radar_20240102-05.grib2.gz").write_bytes(gzip.compress(grib(np.arange(12).reshape(3, 4).astype(float))))
    (path / "bad_20240103.nc").write_bytes(nc()[:300])
    (path / "bad_20240104.zip").write_bytes(archive("none.txt", b""))
    (path / "bad_20240105.bin").write_bytes(b"x")
    return str(path)


def test_decode_files(spark, folder):
    good, bad = decode.split_errors(decode.decode(decode.files(spark, folder)))
    counts = {os.path.basename(r["path"]): r["count"] for r in good.groupBy("path").count().collect()}
    assert counts == {**{f"grid_2024010{d}.nc": 48 for d in range(1, 6)}, "prism_ppt_4km_20240102.zip": 35, "radar_20240102-05.grib2.gz": 12}
    errors = {os.path.basename(r["path"]): r["error"] for r in bad.collect()}
    assert set(errors) == {"bad_20240103.nc", "bad_20240104.zip", "bad_20240105.bin"} and "members" in errors["bad_20240104.zip"]
    told = good.filter("variable = 'ppt'").agg(F.min("time"), F.max("value")).first()
    assert told[0] == datetime(2024, 1, 2) and told[1] == 34.0


def test_files_outside_the_days_are_not_opened(spark, folder):
    """The scan's own metric: files read, after the list was pruned by the metadata predicate."""
    df = decode.files(spark, folder, date(2024, 1, 2), date(2024, 1, 3))
    rows = decode.decode(df, Window(("air",)), drop_missing=True)
    names = {os.path.basename(r["path"]) for r in rows.filter("error IS NULL").select("path").distinct().collect()}
    assert names == {"grid_20240102.nc", "grid_20240103.nc"}
    assert df.inputFiles() is not None
    listed = df._jdf.queryExecution().executedPlan()
    plan = listed.toString()
    assert "file_name" in plan
    scan = df.select("path")
    scan.collect()
    leaves = scan._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = leaves.apply(0).metrics()
    assert metrics.apply("numFiles").value() == 5  # two grids, the raster, the radar field and a broken file, of ten


def gridded(spark, folder, **options):
    return spark.read.format("gridded").option("path", str(folder)).options(**options).load()


def test_data_source_prunes_and_windows(spark, folder):
    datasource.register(spark)
    whole = gridded(spark, folder)
    assert whole.count() == 5 * 48 + 35 + 12 and whole.filter("date = DATE'2024-01-01'").count() == 48 and whole.count() == 5 * 48 + 35 + 12
    want = sorted((date(2024, 1, d), 44.5, lon, 100.0 * (d - 1) + 12 * h + 4 + j) for d in (2, 3) for h in (0, 1) for j, lon in ((1, -96.5), (2, -96.0), (3, -95.5)))
    told = lambda df: sorted(tuple(r) for r in df.select("date", "lat", "lon", "value").collect())
    assert told(gridded(spark, folder, start="2024-01-02", end="2024-01-03", variables="air", box="-96.6,44.4,180,44.6")) == want
    wanted = (F.col("date") >= date(2024, 1, 2)) & (F.col("date") < date(2024, 1, 4)) & (F.col("variable") == "air") & F.col("lat").between(44.4, 44.6) & (F.col("lon") > -96.6)
    assert told(gridded(spark, folder, pushdown="true").filter(wanted)) == told(whole.filter(wanted)) == want
    assert len(datasource.GriddedReader({"path": folder, "variables": "air,rain"}).partitions()) == 20


def test_pushed_filters_narrow_files_and_windows(folder):
    reader = datasource.PushingReader({"path": folder})
    pushed = [GreaterThanOrEqual(("date",), date(2024, 1, 4)), EqualTo(("variable",), "air"), LessThan(("lat",), 44.2), In(("variable",), ("air", "x")), LessThan(("time",), datetime(2024, 1, 5))]
    assert list(reader.pushFilters(pushed)) == pushed
    parts = reader.partitions()
    assert [os.path.basename(p.path) for p in parts] == ["bad_20240104.zip", "grid_20240104.nc", "bad_20240105.bin", "grid_20240105.nc"]
    assert parts[1].window == Window(("air",), BoundingBox(-1e9, -1e9, 1e9, 44.2), None, datetime(2024, 1, 5, 0, 0, 0, 1))
    assert sum(b.num_rows for b in reader.read(parts[1])) == 8
    assert list(datasource.PushingReader({"path": folder}).pushFilters([])) == []


def test_data_source_does_not_open_other_days(spark, tmp_path):
    """Files of other days may not even be readable."""
    (tmp_path / "grid_20240101.nc").write_bytes(nc())
    (tmp_path / "grid_20240102.nc").write_bytes(b"rubbish")
    datasource.register(spark)
    assert gridded(spark, tmp_path, mode="failfast", pushdown="true").filter(F.col("date") == date(2024, 1, 1)).count() == 48
    assert gridded(spark, tmp_path, mode="failfast", end="2024-01-01").count() == 48
    with pytest.raises(Exception, match="neither NetCDF"):
        gridded(spark, tmp_path, mode="failfast").count()
    assert gridded(spark, tmp_path).count() == 48
    with pytest.raises(Exception, match="no granules"):
        gridded(spark, tmp_path / "none").count()


def test_encode_grids(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'2024-01-01 00:00:00', 44.0, -96.0, 1e0, 5), ('a', TIMESTAMP_NTZ'2024-01-01 01:00:00', 44.5, -96.0, NULL, 6), ('a', TIMESTAMP_NTZ'2024-01-01 01:00:00', 44.5, -96.0, 3e0, NULL), ('b', TIMESTAMP_NTZ'1969-12-31 00:00:00', 1.0, 2.0, 4e0, 7) AS t(key, time, lat, lon, x, n)")
    made = decode.encode_grids(rows, ["key"], ["x", "n"])
    back = decode.decode(made.withColumnRenamed("key", "path"), drop_missing=True)
    told = sorted(tuple(r)[:6] for r in back.collect())
    assert told == [
        ("a", "n", datetime(2024, 1, 1), 44.0, -96.0, 5.0), ("a", "n", datetime(2024, 1, 1, 1), 44.5, -96.0, 6.0), ("a", "x", datetime(2024, 1, 1), 44.0, -96.0, 1.0),
        ("a", "x", datetime(2024, 1, 1, 1), 44.5, -96.0, 3.0), ("b", "n", datetime(1969, 12, 31), 1.0, 2.0, 7.0), ("b", "x", datetime(1969, 12, 31), 1.0, 2.0, 4.0),
    ]
    assert decode.decode(made.limit(0).withColumnRenamed("key", "path")).count() == 0
    assert pa.types.is_binary(made.toArrow()["content"].type)


def test_fetch_through_granules(spark, folder, tmp_path):
    """A source's table from files by the read-through store: a wider request loads what is missing alone."""
    names = {"air": "Tair", "rain": "Rainf"}
    box = BoundingBox(-96.6, 44.4, -95.9, 44.6)
    load = sources.granule_loader(spark, folder, "nldas", box, glob="grid_*.nc", rename=names)
    fetch = lambda first, last: sources.fetch(spark, "nldas", str(tmp_path), date(2024, 1, first), date(2024, 1, last), load, ["Tair", "Rainf"], box)
    one = fetch(2, 2).orderBy("time", "lon").collect()
    assert [(r.lat, r.lon, round(r.temperature_c + 273.15, 6), r.precip_mm) for r in one[:2]] == [(44.5, -96.5, 105.0, 12.5), (44.5, -96.0, 106.0, 13.0)]
    assert len(one) == 4 and fetch(1, 3).count() == 12
    radar = sources.granule_loader(spark, folder, "mrms", glob="radar_*")
    made = sources.fetch(spark, "mrms", str(tmp_path), date(2024, 1, 2), date(2024, 1, 2), radar)
    assert made.count() == 12 and made.agg(F.max("precip_mm")).first()[0] == 11.0
    rain = sources.fetch(spark, "prism", str(tmp_path), date(2024, 1, 2), date(2024, 1, 2), sources.granule_loader(spark, folder, "prism", glob="prism_*"), ["ppt"], resolution="4km")
    assert rain.count() == 35 and rain.agg(F.min("time")).first()[0] == datetime(2024, 1, 1, 12)
    with pytest.raises(Exception, match="the file ends|ends within|20240103"):
        sources.fetch(spark, "nldas", str(tmp_path / "x"), date(2024, 1, 3), date(2024, 1, 3), sources.granule_loader(spark, folder, "nldas", glob="*.nc", rename=names), ["Tair"]).count()
    kept = sources.granule_loader(spark, folder, "nldas", glob="*.nc", rename=names, on_error="skip")
    assert sources.fetch(spark, "nldas", str(tmp_path / "y"), date(2024, 1, 3), date(2024, 1, 3), kept, ["Tair"]).count() == 24
