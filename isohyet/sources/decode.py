"""Binary grids to tidy rows: classic NetCDF, GeoTIFF (bare or zipped) and GRIB2, by their published layouts.

``decode`` takes a DataFrame of files (path, content), as ``files`` lists them, and
gives tidy rows (path, variable, time, lat, lon, value, error).  A file is read in
one task, never all at once as rows: windows are cut by index before values are
unpacked, so a box, a time range or a list of variables spares the rest of the file.
A file that can't be read is one row with its error; ``split_errors`` parts the two.
Missing values (fill values, bitmaps, NaN) are NULL, or left out on request.
"""

from __future__ import annotations

import gzip
import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.operators.spatial import BoundingBox

EPOCH = datetime(1970, 1, 1)
ROWS = pa.schema([("variable", pa.string()), ("time", pa.timestamp("us")), ("lat", pa.float64()), ("lon", pa.float64()), ("value", pa.float64())])
SCHEMA = "path string, variable string, time timestamp_ntz, lat double, lon double, value double, error string"


@dataclass(frozen=True)
class Window:
    """What of a file is wanted: variables, a box (edges included) and times from start up to, but without, end; None wants all."""

    variables: tuple[str, ...] | None = None
    box: BoundingBox | None = None
    start: datetime | None = None
    end: datetime | None = None

    def wants(self, variable: str) -> bool:
        return self.variables is None or variable in self.variables

    def holds_time(self, at: datetime) -> bool:
        return (self.start is None or at >= self.start) and (self.end is None or at < self.end)

    def inside(self, x: np.ndarray, axis: str) -> np.ndarray:
        """Indices of coordinates in the box; longitudes are taken from -180 to 180."""
        if self.box is None:
            return np.arange(len(x))
        low, high = (self.box.south, self.box.north) if axis == "lat" else (self.box.west, self.box.east)
        return np.flatnonzero((x >= low) & (x <= high))


def wrap(lon: np.ndarray) -> np.ndarray:
    """Longitudes up to 360 to -180..180; others as they are."""
    return (lon + 180.0) % 360.0 - 180.0 if lon.size and lon.max() > 180 else lon


def _rows(variable: str, at: datetime, lat: np.ndarray, lon: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """One grid of one time; lat and lon are axes, or grids of the same shape."""
    if lat.ndim == 1 and value.ndim == 2:
        lat, lon = np.repeat(lat, value.shape[1]), np.tile(lon, value.shape[0])
    value = np.asarray(value, np.float64).ravel()
    micros = (at - EPOCH) // timedelta(microseconds=1)
    columns = [
        pa.array([variable]).take(pa.array(np.zeros(len(value), np.int32))), pa.array(np.full(len(value), micros, np.int64)).cast(pa.timestamp("us")),
        pa.array(lat.ravel().astype(np.float64)), pa.array(lon.ravel().astype(np.float64)), pa.array(value, mask=np.isnan(value)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=ROWS)


# Classic NetCDF ---------------------------------------------------------------------------------------

# The types of the classic format, by their numbers.
NC_TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
UNIT_SECONDS = {"second": 1, "sec": 1, "s": 1, "minute": 60, "min": 60, "hour": 3600, "hr": 3600, "h": 3600, "day": 86_400, "d": 86_400}


@dataclass
class Variable:
    name: str
    dims: tuple[str, ...]
    attributes: dict[str, object]
    kind: np.dtype
    begin: int
    shape: tuple[int, ...]
    #: Bytes from one record to the next, or None for a variable without a record dimension.
    stride: int | None


class NetCDF:
    """A file of versions 1 (32-bit offsets), 2 (64-bit offsets) or 5 (64-bit sizes), all in one buffer; values are cut from it on demand."""

    def __init__(self, content: bytes) -> None:
        if content[:3] != b"CDF" or content[3] not in (1, 2, 5):
            raise ValueError("no classic NetCDF file")
        self.content, self.at = memoryview(content), 4
        self.version = content[3]
        records = self._size()
        self.dims: dict[str, int] = {}
        names = []
        for _ in range(self._list(10)):
            names.append(self._name())
            self.dims[names[-1]] = self._size()
        unlimited = next((n for n in names if self.dims[n] == 0), None)
        self.attributes = self._attributes()
        self.variables: dict[str, Variable] = {}
        spans = {}
        for _ in range(self._list(11)):
            name = self._name()
            dims = tuple(names[self._size()] for _ in range(self._size()))
            attributes = self._attributes()
            kind = np.dtype(NC_TYPES[self._int()])
            self._size()  # the stored size can overflow; it follows from the shape
            begin = self._int() if self.version == 1 else self._long()
            shape = tuple(0 if d == unlimited else self.dims[d] for d in dims)
            whole = kind.itemsize * int(np.prod([s for d, s in zip(dims, shape, strict=True) if d != unlimited], dtype=np.int64))
            self.variables[name] = Variable(name, dims, attributes, kind, begin, shape, None)
            if unlimited and dims[:1] == (unlimited,):
                spans[name] = whole
        # a single record variable is not padded
        stride = sum(s if len(spans) == 1 else -(-s // 4) * 4 for s in spans.values())
        if unlimited and records == (0xFFFFFFFF if self.version < 5 else 0xFFFFFFFFFFFFFFFF):
            first = min((self.variables[n].begin for n in spans), default=0)
            records = (len(content) - first) // stride if stride else 0
        if unlimited:
            self.dims[unlimited] = records
        for name in spans:
            v = self.variables[name]
            v.stride, v.shape = stride, (records, *v.shape[1:])

    def _take(self, n: int) -> memoryview:
        if self.at + n > len(self.content):
            raise ValueError("the file ends early")
        self.at += n
        return self.content[self.at - n : self.at]

    def _int(self) -> int:
        return struct.unpack(">I", self._take(4))[0]

    def _long(self) -> int:
        return struct.unpack(">Q", self._take(8))[0]

    def _size(self) -> int:
        return self._long() if self.version == 5 else self._int()

    def _name(self) -> str:
        size = self._size()
        return bytes(self._take(-(-size // 4) * 4)[:size]).decode()

    def _list(self, tag: int) -> int:
        found, many = self._int(), self._size()
        if found not in (0, tag) or (found == 0 and many):
            raise ValueError(f"list {tag} expected, {found} found")
        return many

    def _attributes(self) -> dict[str, object]:
        told: dict[str, object] = {}
        for _ in range(self._list(12)):
            name, kind, many = self._name(), np.dtype(NC_TYPES[self._int()]), self._size()
            size = kind.itemsize * many
            data = bytes(self._take(-(-size // 4) * 4)[:size])
            values = np.frombuffer(data, kind)
            told[name] = data.rstrip(b"\0").decode(errors="replace") if kind.kind == "S" else values.item() if many == 1 else values
        return told

    def raw(self, name: str, index: int | None = None) -> np.ndarray:
        """The stored values of a variable, or of one index of its first dimension."""
        v = self.variables[name]
        inner = v.shape[1:] if v.stride is not None or index is not None else v.shape
        size = v.kind.itemsize * int(np.prod(inner, dtype=np.int64))
        if v.stride is not None and index is None:
            return np.stack([self.raw(name, k) for k in range(v.shape[0])]) if v.shape[0] else np.zeros(v.shape, v.kind)
        begin = v.begin + (index or 0) * (v.stride if v.stride is not None else size)
        if begin + size > len(self.content):
            raise ValueError(f"the file ends within {name}")
        return np.frombuffer(self.content[begin : begin + size], v.kind).reshape(inner)

    def unpacked(self, name: str, stored: np.ndarray) -> np.ndarray:
        """Doubles by scale_factor and add_offset; fill values become NaN."""
        told = self.variables[name].attributes
        gone = [np.ravel(told[k]).astype(np.float64) for k in ("_FillValue", "missing_value") if k in told and not isinstance(told[k], str)]
        values = stored.astype(np.float64)
        lost = np.isin(values, np.concatenate(gone)) if gone else np.zeros(values.shape, bool)
        values = values * float(told.get("scale_factor", 1.0)) + float(told.get("add_offset", 0.0))
        values[lost] = np.nan
        return values

    def values(self, name: str) -> np.ndarray:
        return self.unpacked(name, self.raw(name))

    def times(self, name: str) -> list[datetime]:
        """The times of an axis such as "hours since 1900-01-01"; other calendars than the usual one are an error."""
        told = self.variables[name].attributes
        found = re.match(r"\s*(\w+?)s?\s+since\s+(\d+)-(\d+)-(\d+)(?:[T\s]+(\d+):(\d+)(?::(\d+(?:\.\d*)?))?)?", str(told.get("units", "")))
        if not found or found[1].lower() not in UNIT_SECONDS:
            raise ValueError(f"{name} has no time unit that is known: {told.get('units')!r}")
        if str(told.get("calendar", "standard")).lower() not in ("standard", "gregorian", "proleptic_gregorian"):
            raise ValueError(f"calendar {told['calendar']!r} is not known")
        base = datetime(int(found[2]), int(found[3]), int(found[4]), int(found[5] or 0), int(found[6] or 0)) + timedelta(seconds=float(found[7] or 0))
        step = UNIT_SECONDS[found[1].lower()]
        return [base + timedelta(microseconds=round(float(x) * step * 1e6)) for x in self.values(name)]

    def axis(self, *names: str) -> str | None:
        return next((n for n in names if n in self.variables), None)


def netcdf_rows(content: bytes, window: Window) -> Iterator[pa.RecordBatch]:
    """Rows of the variables over (time, lat, lon) or, with grids of latitude and longitude, (time, y, x); a grid is cut before it is unpacked."""
    file = NetCDF(content)
    lat_name, lon_name, time_name = file.axis("lat", "latitude"), file.axis("lon", "longitude"), file.axis("time")
    if not (lat_name and lon_name and time_name):
        raise ValueError("no time, lat and lon")
    lat, lon, times = file.values(lat_name), wrap(file.values(lon_name)), file.times(time_name)
    flat = lat.ndim == 1
    if flat:
        rows, columns = window.inside(lat, "lat"), window.inside(lon, "lon")
    else:
        held = np.ones(lat.shape, bool) if window.box is None else (lat >= window.box.south) & (lat <= window.box.north) & (lon >= window.box.west) & (lon <= window.box.east)
        rows, columns = np.flatnonzero(held.any(axis=1)), np.flatnonzero(held.any(axis=0))
    if not len(rows) or not len(columns):
        return
    a, b, c, d = rows[0], rows[-1] + 1, columns[0], columns[-1] + 1
    grid_dims = file.variables[lat_name].dims + file.variables[lon_name].dims if flat else file.variables[lat_name].dims
    for name, v in file.variables.items():
        if v.dims != (*file.variables[time_name].dims, *grid_dims) or not window.wants(name) or name in (lat_name, lon_name):
            continue
        for k, at in enumerate(times):
            if window.holds_time(at):
                part = file.unpacked(name, file.raw(name, k)[a:b, c:d])
                if flat:
                    yield _rows(name, at, lat[rows], lon[columns], part[np.ix_(rows - a, columns - c)])
                else:
                    cut = held[a:b, c:d]
                    yield _rows(name, at, lat[a:b, c:d][cut], lon[a:b, c:d][cut], part[cut])


def encode_netcdf(dims: dict[str, int | None], variables: dict[str, tuple[tuple[str, ...], np.ndarray, dict[str, object]]], attributes: dict[str, object] | None = None) -> bytes:
    """A version 2 file; None marks the record dimension, whose size is that of the arrays along it."""
    kinds = {np.dtype(v).newbyteorder("="): k for k, v in NC_TYPES.items() if k <= 6}
    name_ = lambda s: struct.pack(">I", len(s.encode())) + s.encode() + b"\0" * (-len(s.encode()) % 4)
    names = list(dims)

    def told(held: dict[str, object] | None) -> bytes:
        if not held:
            return bytes(8)
        out = struct.pack(">II", 12, len(held))
        for key, value in held.items():
            data = np.frombuffer(value.encode(), "S1") if isinstance(value, str) else np.atleast_1d(np.asarray(value))
            kind = 2 if isinstance(value, str) else kinds[data.dtype.newbyteorder("=")]
            raw = data.astype(NC_TYPES[kind]).tobytes()
            out += name_(key) + struct.pack(">II", kind, len(data)) + raw + b"\0" * (-len(raw) % 4)
        return out

    record = next((n for n in names if dims[n] is None), None)
    many = next((v.shape[0] for d, v, _ in variables.values() if d[:1] == (record,)), 0)
    made = {}
    for name, (own, values, held) in variables.items():
        kind = kinds[values.dtype.newbyteorder("=")]
        raw = values.astype(NC_TYPES[kind])
        made[name] = (own, raw, held, kind, own[:1] == (record,))
    alone = sum(m[4] for m in made.values()) == 1
    pad = lambda n: n if alone else -(-n // 4) * 4

    def head(begins: dict[str, int]) -> bytes:
        out = b"CDF\x02" + struct.pack(">I", many) + struct.pack(">II", 10 if names else 0, len(names))
        out += b"".join(name_(n) + struct.pack(">I", dims[n] or 0) for n in names) + told(attributes)
        out += struct.pack(">II", 11 if made else 0, len(made))
        for name, (own, raw, held, kind, grows) in made.items():
            size = pad(raw[0].nbytes if len(raw) else 0) if grows else -(-raw.nbytes // 4) * 4
            out += name_(name) + struct.pack(">I", len(own)) + b"".join(struct.pack(">I", names.index(d)) for d in own) + told(held)
            out += struct.pack(">IIQ", kind, min(size, 0xFFFFFFFF), begins.get(name, 0))
        return out

    at, begins = len(head({})), {}
    for grows in (False, True):
        for name, (_, raw, _, _, own) in made.items():
            if own == grows:
                begins[name] = at
                at += pad(raw[0].nbytes if len(raw) else 0) if grows else -(-raw.nbytes // 4) * 4
    out = [head(begins)]
    for _, raw, _, _, grows in made.values():
        if not grows:
            out.append(raw.tobytes() + b"\0" * (-raw.nbytes % 4))
    for k in range(many):
        for _, raw, _, _, grows in made.values():
            if grows:
                one = raw[k : k + 1].tobytes()  # a bare element would lose its byte order
                out.append(one + b"\0" * (pad(len(one)) - len(one)))
    return b"".join(out)


# GeoTIFF ----------------------------------------------------------------------------------------------

# Sizes and codes of the field types, and the tags that are read.
TIFF_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
TAG = {
    "width": 256, "height": 257, "bits": 258, "compression": 259, "offsets": 273, "samples": 277, "rows": 278, "counts": 279, "predictor": 317, "tile_width": 322,
    "tile_height": 323, "tile_offsets": 324, "tile_counts": 325, "format": 339, "scale": 33550, "tie": 33922, "nodata": 42113,
}


class GeoTiff:
    """The first band of the first image of a TIFF or BigTIFF: strips or tiles, plain, deflated or LZW, with any of the three predictors."""

    def __init__(self, content: bytes) -> None:
        order = {b"II": "<", b"MM": ">"}.get(content[:2])
        magic = struct.unpack(f"{order}H", content[2:4])[0] if order else 0
        if magic not in (42, 43):
            raise ValueError("no TIFF file")
        self.content, self.order = content, order
        big = magic == 43
        at = struct.unpack_from(f"{order}Q" if big else f"{order}I", content, 8 if big else 4)[0]
        count, step, inline = ("Q", 20, 8) if big else ("H", 12, 4)
        self.tags: dict[int, tuple] = {}
        for k in range(struct.unpack_from(f"{order}{count}", content, at)[0]):
            entry = at + struct.calcsize(count) + k * step
            tag, kind, many = struct.unpack_from(f"{order}HH{'Q' if big else 'I'}", content, entry)
            if kind not in TIFF_TYPES:
                continue
            code = f"{order}{many}{TIFF_TYPES[kind]}"
            place = entry + step - inline
            if struct.calcsize(code) > inline:
                place = struct.unpack_from(f"{order}{'Q' if big else 'I'}", content, place)[0]
            self.tags[tag] = struct.unpack_from(code, content, place)
        self.width, self.height = self._tag("width")[0], self._tag("height")[0]
        bits, kind = self._tag("bits", (1,))[0], self._tag("format", (1,))[0]
        if bits not in (8, 16, 32, 64) or kind not in (1, 2, 3):
            raise ValueError(f"samples of {bits} bits and format {kind} are not read")
        self.kind = np.dtype(f"{order}{'uif'[kind - 1]}{bits // 8}")
        self.samples = self._tag("samples", (1,))[0]
        scale, tie = self._tag("scale", None), self._tag("tie", None)
        if scale is None or tie is None:
            raise ValueError("no scale and tie point")
        # the tie point is a pixel's corner; centres lie half a pixel on
        self.lon = tie[3] + (np.arange(self.width) - tie[0] + 0.5) * scale[0]
        self.lat = tie[4] - (np.arange(self.height) - tie[1] + 0.5) * scale[1]
        told = self._tag("nodata", None)
        self.nodata = float(told[0].rstrip(b"\0 ").decode()) if told else None
        tiled = TAG["tile_offsets"] in self.tags
        self.block = (self._tag("tile_height")[0], self._tag("tile_width")[0]) if tiled else (min(self._tag("rows", (self.height,))[0], self.height), self.width)
        self.offsets, self.counts = (self._tag("tile_offsets"), self._tag("tile_counts")) if tiled else (self._tag("offsets"), self._tag("counts"))
        self.tiled = tiled

    def _tag(self, name: str, other: tuple | None = ()) -> tuple | None:
        found = self.tags.get(TAG[name], other)
        if found == ():
            raise ValueError(f"the TIFF has no {name}")
        return found

    def _block(self, k: int, rows: int) -> np.ndarray:
        data = self.content[self.offsets[k] : self.offsets[k] + self.counts[k]]
        if len(data) < self.counts[k]:
            raise ValueError("the file ends within a block")
        how = self._tag("compression", (1,))[0]
        if how in (8, 32946):
            data = zlib.decompress(data)
        elif how == 5:
            data = lzw(data)
        elif how != 1:
            raise ValueError(f"compression {how} is not read")
        width, size = self.block[1] * self.samples, self.kind.itemsize
        if len(data) < rows * width * size:
            raise ValueError("a block is short")
        predictor = self._tag("predictor", (1,))[0]
        if predictor == 3:
            # bytes of a row stand by significance, each the difference to the one a sample before
            planes = np.frombuffer(data, np.uint8)[: rows * width * size].reshape(rows, size * self.block[1], self.samples)
            planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, size, width)
            return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, self.block[1], self.samples)[:, :, 0]
        values = np.frombuffer(data, self.kind)[: rows * width].reshape(rows, self.block[1], self.samples)
        if predictor == 2:
            values = np.cumsum(values.astype(self.kind.newbyteorder("=")), axis=1, dtype=self.kind.newbyteorder("="))
        return values[:, :, 0]

    def window(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Values as doubles of the given rows and columns; blocks outside them are not unpacked."""
        out = np.full((len(rows), len(columns)), np.nan)
        high, wide = self.block
        across = -(-self.width // wide)
        for i in np.unique(rows // high):
            for j in np.unique(columns // wide):
                tall = high if self.tiled else min(high, self.height - i * high)
                block = self._block(int(i * across + j), int(tall))
                own_rows, own_columns = np.flatnonzero(rows // high == i), np.flatnonzero(columns // wide == j)
                out[np.ix_(own_rows, own_columns)] = block[np.ix_(rows[own_rows] - i * high, columns[own_columns] - j * wide)]
        if self.nodata is not None:
            out[np.isclose(out, self.nodata, rtol=1e-6, atol=0) | (out == self.nodata)] = np.nan
        return out


def lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits from the high end, 256 clears and 257 ends, widths grow one code early."""
    out, held, wide = bytearray(), 0, 0
    table: list[bytes] = [bytes([k]) for k in range(256)] + [b"", b""]
    bits, before = 9, b""
    for byte in data:
        held, wide = (held << 8) | byte, wide + 8
        while wide >= bits:
            code = (held >> (wide - bits)) & ((1 << bits) - 1)
            wide -= bits
            held &= (1 << wide) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                del table[258:]
                bits, before = 9, b""
                continue
            if code > len(table) or (code == len(table) and not before):
                raise ValueError("a bad LZW code")
            entry = table[code] if code < len(table) else before + before[:1]
            out += entry
            if before:
                table.append(before + entry[:1])
            before = entry
            bits = min(12, max(9, (len(table) + 1).bit_length()))
    return bytes(out)


def geotiff_rows(content: bytes, variable: str, at: datetime, window: Window) -> Iterator[pa.RecordBatch]:
    """Rows of a raster, a row of blocks at a time."""
    if not (window.wants(variable) and window.holds_time(at)):
        return
    image = GeoTiff(content)
    rows, columns = window.inside(image.lat, "lat"), window.inside(image.lon, "lon")
    for i in np.unique(rows // image.block[0]):
        part = rows[rows // image.block[0] == i]
        if len(columns):
            yield _rows(variable, at, image.lat[part], image.lon[columns], image.window(part, columns))


def zipped(content: bytes, ending: str = ".tif") -> bytes:
    """The one member of an archive with that ending."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = [n for n in archive.namelist() if n.lower().endswith(ending)]
        if len(names) != 1:
            raise ValueError(f"the archive has {len(names)} members with {ending}")
        return archive.read(names[0])


# GRIB2 ------------------------------------------------------------------------------------------------

# Names of (discipline, category, number); others are "unknown".
GRIB_NAMES = {(0, 1, 8): "tp", (0, 1, 7): "prate", (0, 0, 0): "t", (0, 3, 0): "sp", (0, 2, 2): "u", (0, 2, 3): "v", (0, 1, 0): "q"}


def _signed(value: int, bits: int) -> int:
    """Sign and magnitude, as the format has it."""
    top = 1 << (bits - 1)
    return -(value & (top - 1)) if value & top else value


def _unpack(data: bytes, bits: int, many: int) -> np.ndarray:
    """Unsigned numbers of any width up to 32 bits from the high end."""
    if bits == 0:
        return np.zeros(many, np.uint32)
    if len(data) * 8 < bits * many:
        raise ValueError("the data section is short")
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", many).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8, -(-bits * many // 8)))[: bits * many].reshape(many, bits)
    out = np.zeros(many, np.uint32)
    for k in range(bits):
        out = (out << np.uint32(1)) | flags[:, k]
    return out


def png_values(data: bytes) -> np.ndarray:
    """Samples of a PNG without interlace: grey of up to 16 bits, or three or four bytes read as one number."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG image")
    at, packed, head = 8, [], None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", data, at + 8)
        elif kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + size])
        at += size + 12
    if head is None:
        raise ValueError("the PNG has no header")
    width, height, depth, colour, _, _, interlaced = head
    channels = {0: 1, 2: 3, 6: 4}.get(colour, 0)
    if interlaced or not channels or (channels > 1 and depth != 8):
        raise ValueError(f"PNG of colour type {colour} and {depth} bits is not read")
    line, near = -(-width * channels * depth // 8), max(1, channels * depth // 8)
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    if len(raw) < height * (line + 1):
        raise ValueError("the PNG is short")
    raw = raw[: height * (line + 1)].reshape(height, line + 1)
    rows = np.zeros((height + 1, line), np.uint8)
    for k in range(height):
        how, told, above = raw[k, 0], raw[k, 1:], rows[k]
        if how == 0:
            rows[k + 1] = told
        elif how == 1:
            lanes = np.pad(told, (0, -line % near)).reshape(-1, near)
            rows[k + 1] = np.cumsum(lanes, axis=0, dtype=np.uint8).ravel()[:line]
        elif how == 2:
            rows[k + 1] = told + above
        elif how in (3, 4):
            rows[k + 1] = _unfiltered(how, told.tolist(), above.tolist(), near)
        else:
            raise ValueError(f"PNG filter {how} is not known")
    bytes_ = rows[1:]
    if depth < 8:
        parts = np.unpackbits(bytes_, axis=1).reshape(height, -1, depth)[:, :width]
        return (parts * (1 << np.arange(depth)[::-1])).sum(axis=2).astype(np.uint32).ravel()
    lanes = bytes_.reshape(height * width, near).astype(np.uint32)
    return (lanes << (8 * np.arange(near)[::-1].astype(np.uint32))).sum(axis=1).astype(np.uint32)


def _unfiltered(how: int, told: list[int], above: list[int], near: int) -> list[int]:
    """A line by the mean of left and above (3), or by that of left, above and corner which lies next to their plane (4)."""
    out = told[:]
    for k in range(len(told)):
        left, up, corner = (out[k - near] if k >= near else 0), above[k], (above[k - near] if k >= near else 0)
        if how == 3:
            guess = (left + up) >> 1
        else:
            plane = left + up - corner
            guess = min((abs(plane - left), 0, left), (abs(plane - up), 1, up), (abs(plane - corner), 2, corner))[2]
        out[k] = (told[k] + guess) & 255
    return out


def grib2_rows(content: bytes, window: Window) -> Iterator[pa.RecordBatch]:
    """Rows of every field on a regular grid (template 3.0) with simple packing (5.0) or as a PNG (5.41) and, if it has one, a bitmap."""
    at = 0
    while at < len(content):
        if content[at : at + 4] != b"GRIB":
            raise ValueError("no GRIB message")
        if content[at + 7] != 2:
            raise ValueError(f"GRIB edition {content[at + 7]} is not read")
        discipline, end = content[at + 6], at + struct.unpack_from(">Q", content, at + 8)[0]
        if end > len(content) or content[end - 4 : end] != b"7777":
            raise ValueError("the message ends early")
        at += 16
        base = grid = product = packing = None
        bitmap: np.ndarray | None = None
        while at < end - 4:
            size, number = struct.unpack_from(">IB", content, at)
            if size < 5 or at + size > end:
                raise ValueError("a section has a bad length")
            s = content[at : at + size]
            if number == 1:
                year, *rest = struct.unpack_from(">HBBBBB", s, 12)
                base = datetime(year, *rest)
            elif number == 3:
                grid = _regular_grid(s)
            elif number == 4:
                product = (discipline, s[9], s[10]), _forecast(s)
            elif number == 5:
                many, template, level, two, ten, bits = struct.unpack_from(">IHfHHB", s, 5)
                if template not in (0, 41):
                    raise ValueError(f"packing template {template} is not read")
                packing = many, level, _signed(two, 16), _signed(ten, 16), bits, template == 41
            elif number == 6 and s[5] == 0:
                bitmap = np.unpackbits(np.frombuffer(s, np.uint8, offset=6)).astype(bool)
            elif number == 6 and s[5] == 255:
                bitmap = None
            elif number == 7:
                name, time = GRIB_NAMES.get(product[0], "unknown"), base + product[1]
                if window.wants(name) and window.holds_time(time):
                    lat, lon, order = grid
                    many, level, two, ten, bits, image = packing
                    stored = png_values(s[5:]) if image and bits else _unpack(s[5:], bits, many)
                    if len(stored) != many:
                        raise ValueError("the field has another size than told")
                    value = (level + stored * 2.0**two) / 10.0**ten
                    if bitmap is not None:
                        full = np.full(len(lat) * len(lon), np.nan)
                        full[bitmap[: len(full)]] = value
                        value = full
                    field = order(value)
                    rows, columns = window.inside(lat, "lat"), window.inside(lon, "lon")
                    if len(rows) and len(columns):
                        yield _rows(name, time, lat[rows], lon[columns], field[np.ix_(rows, columns)])
            at += size
        at = end


def _forecast(s: bytes) -> timedelta:
    unit, ahead = struct.unpack_from(">BI", s, 17)
    if unit not in (0, 1, 2, 13):
        raise ValueError(f"time unit {unit} is not read")
    return timedelta(seconds=ahead * {0: 60, 1: 3600, 2: 86_400, 13: 1}[unit])


def _regular_grid(s: bytes) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    if struct.unpack_from(">H", s, 12)[0] != 0:
        raise ValueError(f"grid template {struct.unpack_from('>H', s, 12)[0]} is not read")
    columns, rows = struct.unpack_from(">II", s, 30)
    first_lat, first_lon, _, last_lat, last_lon = struct.unpack_from(">IIBII", s, 46)
    mode = s[71]
    lat = np.linspace(_signed(first_lat, 32) / 1e6, _signed(last_lat, 32) / 1e6, rows)
    a, b = _signed(first_lon, 32) / 1e6, _signed(last_lon, 32) / 1e6
    if not mode & 0x80 and b < a:
        b += 360
    lon = np.linspace(a, b, columns)
    wrapped = np.where(lon > 180, (lon + 180) % 360 - 180, lon)

    def order(value: np.ndarray) -> np.ndarray:
        if len(value) != rows * columns:
            raise ValueError("the field does not fill its grid")
        if mode & 0x20:
            field = value.reshape(columns, rows)
            if mode & 0x10:
                field = np.where((np.arange(columns) % 2 == 1)[:, None], field[:, ::-1], field)
            return field.T
        field = value.reshape(rows, columns)
        return np.where((np.arange(rows) % 2 == 1)[:, None], field[:, ::-1], field) if mode & 0x10 else field

    return lat, wrapped, order


# Files to rows ----------------------------------------------------------------------------------------


def any_rows(path: str, content: bytes, window: Window, variable: str | None = None, at: datetime | None = None) -> Iterator[pa.RecordBatch]:
    """By content: gzip and zip are opened, then NetCDF, GRIB2 or TIFF; a raster's variable and time come from its name unless they are given."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    if content[:2] == b"PK":
        content = zipped(content)
    if content[:3] == b"CDF":
        yield from netcdf_rows(content, window)
    elif content[:4] == b"GRIB":
        yield from grib2_rows(content, window)
    elif content[:2] in (b"II", b"MM"):
        named = re.search(r"([A-Za-z][A-Za-z0-9]*)_[^/]*?(\d{8})[^/]*$", path.rsplit("/", 1)[-1].removeprefix("prism_"))
        if not (variable and at) and not named:
            raise ValueError("the name tells no variable and day")
        yield from geotiff_rows(content, variable or named[1], at or datetime.strptime(named[2], "%Y%m%d"), window)
    else:
        raise ValueError("neither NetCDF, GRIB2 nor TIFF")


def decode(files: DataFrame, window: Window | None = None, drop_missing: bool = False) -> DataFrame:
    """Tidy rows (path, variable, time, lat, lon, value, error) of files (path, content), each read by one task.

    A file that fails gives one row with the error and no value.  What it gave
    before it failed stays, so take good rows of whole files by ``split_errors``.
    """
    wanted = window or Window()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                path, problem = path.as_py(), None
                try:
                    if content.as_py() is None:
                        raise ValueError("no content")
                    for made in any_rows(path or "", content.as_py(), wanted):
                        if drop_missing:
                            made = made.filter(made["value"].is_valid())
                        many = made.num_rows
                        yield pa.RecordBatch.from_arrays([pa.array([path] * many, pa.string()), *made.columns, pa.nulls(many, pa.string())], names=["path", *ROWS.names, "error"])
                except (ValueError, KeyError, IndexError, OverflowError, EOFError, OSError, struct.error, zlib.error, zipfile.BadZipFile) as error:
                    problem = f"{type(error).__name__}: {error}"
                if problem:
                    empty = [pa.nulls(1, t) for t in ROWS.types]
                    yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), *empty, pa.array([problem])], names=["path", *ROWS.names, "error"])

    return files.select("path", "content").mapInArrow(work, SCHEMA)


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the files without an error, and the table of errors (path, error); files are matched by path."""
    bad = rows.filter(F.col("error").isNotNull()).select("path", "error")
    return rows.filter(F.col("error").isNull()).drop("error").join(bad.select("path").distinct(), "path", "left_anti"), bad


def name_date(name: Column, pattern: str = r"(\d{8})") -> Column:
    """The day in a file's name."""
    return F.try_to_date(F.regexp_extract(name, pattern, 1), "yyyyMMdd")


def files(spark: SparkSession, path: str, start: date | None = None, end: date | None = None, pattern: str = r"(\d{8})", glob: str | None = None) -> DataFrame:
    """path and content of the files below a path whose names hold a day from start to end (both included).

    The day is a predicate on the metadata of files, which prunes the list of
    files when the query is planned: others are not opened.  Any file system that
    Spark reads will do.  Spark lists no file of no bytes.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    day = name_date(F.col("_metadata.file_name"), pattern)
    if start is not None:
        found = found.filter(day >= F.lit(start))
    if end is not None:
        found = found.filter(day <= F.lit(end))
    return found.select("path", "content")


def encode_grids(rows: DataFrame, keys: list[str], values: list[str], units: str = "hours since 1970-01-01 00:00:00") -> DataFrame:
    """One classic NetCDF file (keys, content) for each key from rows (keys, time, lat, lon, values); cells without a row hold the fill value.

    A file is made by one task, so keys should name a day or a month of a grid, as
    the files of a store do.  Of rows at one time and place the greatest values stay.
    """
    kinds = dict(rows.dtypes)

    def work(key: tuple, table: pa.Table) -> pa.Table:
        numbers = lambda c: table[c].cast(pa.float64()).to_numpy()
        seconds = table["time"].cast(pa.int64()).to_numpy() / 1e6
        axes = [np.unique(x, return_inverse=True) for x in (seconds, numbers("lat"), numbers("lon"))]
        shape = tuple(len(a[0]) for a in axes)
        step = UNIT_SECONDS[units.split()[0].rstrip("s")]
        made: dict[str, tuple[tuple[str, ...], np.ndarray, dict[str, object]]] = {
            "time": (("time",), axes[0][0] / step, {"units": units}),
            "lat": (("lat",), axes[1][0], {"units": "degrees_north"}),
            "lon": (("lon",), axes[2][0], {"units": "degrees_east"}),
        }
        for v in values:
            grid = np.full(shape, -np.inf)
            x = numbers(v)
            np.fmax.at(grid, tuple(a[1] for a in axes), np.where(np.isnan(x), -np.inf, x))
            made[v] = ("time", "lat", "lon"), np.where(np.isneginf(grid), -9999.0, grid), {"_FillValue": -9999.0}
        content = encode_netcdf({"time": None, "lat": shape[1], "lon": shape[2]}, made)
        return pa.table({**{k: pa.array([x.as_py()], x.type) for k, x in zip(keys, key, strict=True)}, "content": pa.array([content], pa.binary())})

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", content binary"
    return rows.select(*keys, "time", "lat", "lon", *values).groupBy(*keys).applyInArrow(work, schema)
