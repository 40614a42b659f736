"""Vector files and projections: published examples, round trips through every format, errors, unions."""

import io
import json
import sqlite3
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from isohyet.functions import projection as pr
from isohyet.sources import vector

ALBERS_WKT = """PROJCS["Albers",GEOGCS["NAD83",DATUM["D_North_American_1983",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],
PROJECTION["Albers"],PARAMETER["False_Easting",0.0],PARAMETER["False_Northing",0.0],PARAMETER["Central_Meridian",-96.0],PARAMETER["Standard_Parallel_1",29.5],
PARAMETER["Standard_Parallel_2",45.5],PARAMETER["Latitude_Of_Origin",23.0],UNIT["Meter",1.0]]"""
FEET_WKT = """PROJCRS["south",BASEGEOGCRS["NAD83",DATUM["North American Datum 1983",ELLIPSOID["GRS 1980",6378137,298.257222101,LENGTHUNIT["metre",1]]]],
CONVERSION["c",METHOD["Lambert Conic Conformal (2SP)",ID["EPSG",9802]],PARAMETER["Latitude of false origin",43,ANGLEUNIT["degree",0.0174532925199433]],
PARAMETER["Longitude of false origin",-94,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Latitude of 1st standard parallel",45.2166666666667,ANGLEUNIT["degree",0.0174532925199433]],
PARAMETER["Latitude of 2nd standard parallel",43.7833333333333,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Easting at false origin",2624666.667,LENGTHUNIT["US survey foot",0.304800609601219]],
PARAMETER["Northing at false origin",328083.333,LENGTHUNIT["US survey foot",0.304800609601219]]],CS[Cartesian,2],AXIS["easting (X)",east],LENGTHUNIT["US survey foot",0.304800609601219]]"""
SYSTEMS = ["EPSG:4326", "EPSG:26915", "EPSG:32715", "EPSG:3857", "EPSG:5070", ALBERS_WKT, FEET_WKT]
SQUARE = np.array([(-95.0, 44.0), (-94.0, 44.0), (-94.0, 45.0), (-95.0, 45.0), (-95.0, 44.0)])
NEXT, HOLE = SQUARE + (1.0, 0.0), (SQUARE - (-94.5, 44.5)) * 0.5 + (-94.5, 44.5)
ROWS = [({"zone": "é1", "n": "1"}, [SQUARE, HOLE[::-1]]), ({"zone": "é1", "n": None}, [NEXT]), ({"zone": "b", "n": "3"}, [SQUARE + 3.0, SQUARE + 5.0]), ({"zone": None, "n": "4"}, None)]


def rounded(rings):
    return None if rings is None else [[(round(p["x"], 8), round(p["y"], 8)) for p in r] for r in rings]


WANT = [(row, None if rings is None else [[tuple(map(float, p)) for p in r.round(8)] for r in rings]) for row, rings in ROWS]


def projected(crs):
    to = pr.from_text(crs)
    return [(row, None if rings is None else [np.stack(to.forward(r[:, 0], r[:, 1]), axis=1) for r in rings]) for row, rings in ROWS]


def wkb(rings, order="<", z=False):
    polygon = struct.pack(order + "BII", order == "<", 1003 if z else 3, len(rings))
    for r in rings:
        r = np.hstack([r, np.ones((len(r), 1))]) if z else r
        polygon += struct.pack(order + "I", len(r)) + r.astype(order + "f8").tobytes()
    return polygon


def many_wkb(rings):
    """One polygon for each ring, in the long form with a reference system, big-endian."""
    return struct.pack(">BIII", 0, 0x20000006, 4326, len(rings)) + b"".join(wkb([r], ">", True) for r in rings)


def test_published_examples():
    """Snyder's worked examples on the ellipsoid of 1866."""
    clarke = {"axis": 6378206.4, "flattening": 1 - (1 - 0.00676866) ** 0.5}
    for kind, told, at, want in (
        (pr.LAMBERT, {"lat_1": 33, "lat_2": 45, "lat_0": 23, "lon_0": -96}, (-75, 35), (1894410.9, 1564649.5)),
        (pr.ALBERS, {"lat_1": 29.5, "lat_2": 45.5, "lat_0": 23, "lon_0": -96}, (-75, 35), (1885472.7, 1535925.0)),
        (pr.TRANSVERSE, {"lat_0": 0, "lon_0": -75, "k_0": 0.9996}, (-73.5, 40.5), (127106.5, 4484124.4)),
    ):
        made = pr.Projection(kind, told, **clarke)
        x, y = made.forward(np.array([at[0]]), np.array([at[1]]))
        assert (x[0], y[0]) == pytest.approx(want, abs=0.06)


@pytest.mark.parametrize("crs", SYSTEMS)
def test_there_and_back(crs):
    lon, lat = np.meshgrid(np.linspace(-97, -89, 9), np.linspace(35, 50, 7))
    made = pr.from_text(crs)
    back = made.inverse(*made.forward(lon, lat))
    assert np.abs(back[0] - lon).max() < 1e-10 and np.abs(back[1] - lat).max() < 1e-10


def test_text_and_number_name_the_same():
    lon, lat = np.array([-95.3, -90.0]), np.array([44.1, 38.0])
    assert np.allclose(pr.from_text(ALBERS_WKT).forward(lon, lat), pr.from_epsg(5070).forward(lon, lat), atol=1e-3)
    assert np.allclose(pr.from_text("urn:ogc:def:crs:EPSG::26915").forward(lon, lat), pr.from_epsg(32615).forward(lon, lat), atol=1e-3)
    x, y = pr.from_text(FEET_WKT).forward(np.array([-94.0]), np.array([43.0]))
    assert (x[0], y[0]) == pytest.approx((2624666.667, 328083.333), abs=1e-3)
    for wrong in ("EPSG:27700", "", "nothing", ALBERS_WKT.replace("6378137.0,298.257222101", "6378206.4,294.978698214"), ALBERS_WKT.replace('["Albers"],PAR', '["Bonne"],PAR')):
        with pytest.raises(ValueError):
            pr.from_text(wrong)


def frame(spark, files):
    return spark.createDataFrame([(p, bytearray(c) if c is not None else None) for p, c in files.items()], "path string, content binary")


def read(spark, files, **more):
    return sorted(vector.decode(frame(spark, files), **more).collect(), key=lambda r: (r.path, -1 if r.feature is None else r.feature))


@pytest.mark.parametrize("crs", SYSTEMS)
def test_shapefiles(spark, crs):
    parts = vector.shapefile(projected(crs), crs)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for ending, content in parts.items():
            z.writestr(f"in/a.{ending}", content)
    got = read(spark, {**{f"/x/a.{e}": c for e, c in parts.items()}, "/x/b.ZIP": packed.getvalue()})
    assert [r.path for r in got] == ["/x/a.shp"] * 4 + ["/x/b.ZIP"] * 4
    for name in ("/x/a.shp", "/x/b.ZIP"):
        assert [(r.properties, rounded(r.rings)) for r in got if r.path == name] == WANT


def test_deleted_rows_go(spark):
    parts = vector.shapefile(ROWS, "EPSG:4326")
    width = struct.unpack_from("<H", parts["dbf"], 10)[0]
    head = struct.unpack_from("<H", parts["dbf"], 8)[0]
    parts["dbf"] = parts["dbf"][: head + width] + b"*" + parts["dbf"][head + width + 1 :]
    got = read(spark, {f"a.{e}": c for e, c in parts.items()})
    assert [(r.properties, rounded(r.rings)) for r in got] == [WANT[0], *WANT[2:]]


def geopackage(crs):
    base = sqlite3.connect(":memory:")
    base.executescript(
        "CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);"
        "CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER, organization TEXT, organization_coordsys_id INTEGER, definition TEXT);"
        'CREATE TABLE "my ""layer" (fid INTEGER PRIMARY KEY, geom BLOB, zone TEXT, n INTEGER);'
        "INSERT INTO gpkg_geometry_columns VALUES ('my \"layer', 'geom', 'MULTIPOLYGON', 7, 0, 0);"
    )
    base.execute("INSERT INTO gpkg_spatial_ref_sys VALUES ('s', 7, 'none', 7, ?)", (crs,))
    for k, (row, rings) in enumerate(projected(crs)):
        blob = None if rings is None else b"GP\0\x03" + struct.pack("<i4d", 7, 0, 0, 0, 0) + (many_wkb(rings) if k % 2 else wkb(rings))
        base.execute('INSERT INTO "my ""layer" VALUES (?, ?, ?, ?)', (k + 1, blob, row["zone"], row["n"]))
    base.commit()
    return base.serialize()


def geoparquet(crs, rows):
    table = pa.table({"zone": [r["zone"] for r, _ in rows], "n": [r["n"] for r, _ in rows], "geometry": pa.array([None if x is None else many_wkb(x) for _, x in rows], pa.binary())})
    told = {"primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", **crs}}}
    out = io.BytesIO()
    pq.write_table(table.replace_schema_metadata({"geo": json.dumps(told)}), out)
    return out.getvalue()


def test_other_formats(spark):
    features = [
        {"type": "Feature", "properties": row, "geometry": None if rings is None else {"type": "Polygon", "coordinates": [r.tolist() for r in rings]}} for row, rings in ROWS
    ]
    moved = json.dumps({"type": "FeatureCollection", "features": features[:1], "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::4269"}}})
    got = read(
        spark,
        {
            "a.gpkg": geopackage(ALBERS_WKT), "b.geojson": json.dumps({"type": "FeatureCollection", "features": features}).encode(), "c.json": moved.encode(),
            "d.parquet": geoparquet({}, ROWS), "e.parquet": geoparquet({"crs": {"id": {"authority": "EPSG", "code": 26915}}}, projected("EPSG:26915")),
        },
    )
    by = {name: [({k: v for k, v in r.properties.items() if k != "fid"}, rounded(r.rings)) for r in got if r.path == name] for name in {r.path for r in got}}
    assert all(r.error is None for r in got)
    assert by["c.json"] == WANT[:1]
    for name in ("a.gpkg", "b.geojson", "d.parquet", "e.parquet"):
        assert by[name] == WANT, name


def test_errors_are_rows(spark):
    parts = vector.shapefile(ROWS, "EPSG:4326")
    broken = {
        "a.gpkg": b"no", "b.json": b"{", "c.parquet": b"PAR1", "d.zip": b"PK", "e.tab": b"", "f.shp": parts["shp"], "g.dbf": parts["dbf"], "h.shp": parts["shp"][:150], "h.prj": parts["prj"],
        "i.geojson": None, "k.shp": parts["shp"], "k.prj": b"LOCAL_CS", "l.parquet": geoparquet({"crs": None}, ROWS), "no ending": b"x",
    }
    got = read(spark, broken)
    assert len(got) == len(broken) - 2 and all(r.error and r.rings is None and r.feature is None for r in got)
    assert "no coordinate system" in next(r.error for r in got if r.path == "f.shp")
    assert [rounded(r.rings) for r in read(spark, {"f.shp": parts["shp"]}, crs="EPSG:4326")] == [r for _, r in WANT]
    assert read(spark, {}) == []


def test_polygons_of_a_folder(spark, tmp_path):
    for k, crs in enumerate(("EPSG:26915", FEET_WKT)):
        for ending, content in vector.shapefile(projected(crs)[2 * k : 2 * k + 2], crs).items():
            (tmp_path / f"part{k}.{ending}").write_bytes(content)
    (tmp_path / "notes.txt").write_text("not a vector file")
    made = {r.zone: r for r in vector.load_polygons(spark, str(tmp_path), "zone").collect()}
    assert set(made) == {"é1", "b"} and made["é1"].parts == 1 and made["b"].parts == 2
    square = lambda s, n: float(np.diff(vector.geo.authalic_number(np.array([s, n])))[0])
    assert made["é1"].area == pytest.approx(2 * square(44, 45) - 0.5 * square(44.25, 44.75), abs=1e-7)
    assert made["b"].area == pytest.approx(square(47, 48) + square(49, 50), abs=1e-7)
    plain = vector.load_polygons(spark, str(tmp_path / "part0.shp")).collect()
    assert sorted(r.feature for r in plain) == [0, 1] and {r.properties["zone"] for r in plain} == {"é1"}
    with pytest.raises(Exception, match="lacks the attribute huc"):
        vector.load_polygons(spark, str(tmp_path), "huc").collect()
    (tmp_path / "bad.gpkg").write_bytes(b"nothing")
    with pytest.raises(Exception, match="bad.gpkg"):
        vector.load_polygons(spark, str(tmp_path), "zone").collect()
