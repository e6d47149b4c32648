"""PBF against a writer of our own, limit areas against literal files."""

import json
import random
import struct
import zlib

import pytest

from mapforge.geometry import codec as C
from mapforge.geometry import planar as P
from mapforge.sources import areas, pbf


def varint(v):
    v &= (1 << 64) - 1
    out = b""
    while v > 0x7F:
        out += bytes([v & 0x7F | 0x80])
        v >>= 7
    return out + bytes([v])


def zig(v):
    return varint((v << 1) ^ (v >> 63))


def item(n, v):
    return varint(n << 3 | 2) + varint(len(v)) + v if isinstance(v, bytes) else varint(n << 3) + varint(v)


def deltas(values):
    return b"".join(zig(b - a) for a, b in zip([0, *values], values))


def blob(kind, message, deflate=True):
    body = item(2, len(message)) + item(3, zlib.compress(message)) if deflate else item(1, message)
    head = item(1, kind) + item(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def sample(strings, *groups):
    return item(1, b"".join(item(1, s.encode()) for s in strings)) + b"".join(item(2, g) for g in groups)


@pytest.fixture
def path(tmp_path):
    s = ["", "place", "city", "name", "Köln", "type", "multipolygon", "outer"]
    ids, lats, lons = [5, 7, 1 << 40], [475000000, -900000000, 1], [130000000, 1800000000, -1]
    dense = item(2, item(1, deltas(ids)) + item(8, deltas(lats)) + item(9, deltas(lons)) + item(10, bytes([1, 2, 3, 4, 0, 0, 3, 4, 0])))
    plain = item(1, item(1, 18) + item(2, bytes([1])) + item(3, bytes([2])) + item(8, 200) + item(9, 401))
    way = item(3, item(1, 11) + item(2, bytes([3])) + item(3, bytes([4])) + item(8, deltas([5, 7, 5])))
    bare = item(3, item(1, 12) + item(8, deltas([7])))
    rel = item(4, item(1, 20) + item(2, bytes([5])) + item(3, bytes([6])) + item(8, bytes([7, 0])) + item(9, deltas([11, 5])) + item(10, bytes([1, 0])))
    data = blob(b"OSMHeader", item(4, b"OsmSchema-V0.6") + item(4, b"DenseNodes")) + blob(b"OSMData", sample(s, dense, plain)) + blob(b"OSMData", sample(s, way, bare, rel), deflate=False)
    (tmp_path / "a.osm.pbf").write_bytes(data)
    return str(tmp_path / "a.osm.pbf")


@pytest.mark.parametrize("read", [lambda s, p: pbf.read_pbf(s, p, partition_bytes=1), pbf.read_pbf_files])
def test_pbf(spark, path, read):
    e = read(spark, path)
    assert sorted(map(tuple, e.coords.collect())) == [(5, 13.0, 47.5), (7, 180.0, -90.0), (9, -0.0000201, 0.00001), (1 << 40, -1e-7, 1e-7)]
    assert {r["osm_id"]: r["tags"] for r in e.nodes.collect()} == {5: {"place": "city", "name": "Köln"}, 9: {"place": "city"}, 1 << 40: {"name": "Köln"}}
    assert {r["osm_id"]: (r["tags"], r["refs"]) for r in e.ways.collect()} == {11: ({"name": "Köln"}, [5, 7, 5]), 12: ({}, [7])}
    (rel,) = e.relations.collect()
    assert [tuple(m) for m in rel["members"]] == [(11, "way", "outer"), (5, "node", "")] and rel["tags"] == {"type": "multipolygon"}


def test_pbf_lists_of_numbers():
    r = random.Random(3)
    values = [0, 1, -1, (1 << 63) - 1, -(1 << 63), *[r.getrandbits(r.randint(1, 63)) * r.choice([1, -1]) for _ in range(500)]]
    for data, signed in ((b"".join(map(zig, values)), True), (b"".join(varint(v & ((1 << 64) - 1)) for v in values), False)):
        assert pbf.packed(data, signed) == pbf.numbers(data, signed).tolist() == values
    assert pbf.numbers(b"").tolist() == []
    with pytest.raises(ValueError):
        pbf.numbers(b"\x01\x80")


def test_pbf_refuses_what_it_does_not_know(tmp_path):
    with pytest.raises(ValueError):
        pbf.check_header(item(4, b"HistoricalInformation"))
    (tmp_path / "b.pbf").write_bytes(blob(b"OSMData", sample([""]))[:-3])
    with pytest.raises(ValueError):
        list(pbf.blobs(str(tmp_path / "b.pbf")))


def size(g):
    return P.area(g)


def test_areas(spark, tmp_path):
    wkt = tmp_path / "a.txt"
    wkt.write_text("﻿POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))\n\nPOINT(1 1)\nMULTIPOLYGON(((20 0, 21 0, 21 1, 20 0)))\n", encoding="utf-8")
    assert size(areas.load_area(spark, str(wkt))) == 100.5
    ring = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    features = [{"type": "Feature", "properties": {"name": n}, "geometry": {"type": "Polygon", "coordinates": [ring]}} for n in ("a", "b")]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    assert size(areas.load_area(spark, str(tmp_path / "a.geojson"))) == 8
    assert size(areas.load_area(spark, str(tmp_path / "a.geojson"), "name = 'b'")) == 4
    shell, hole = [(0, 0), (0, 10), (10, 10), (10, 0), (0, 0)], [(2, 2), (8, 2), (8, 8), (2, 8), (2, 2)]
    body = struct.pack("<i4d2i2i", 5, 0, 0, 10, 10, 2, 10, 0, 5) + b"".join(struct.pack("<2d", *p) for p in shell + hole)
    (tmp_path / "a.shp").write_bytes(struct.pack(">i", 9994) + bytes(96) + struct.pack(">2i", 1, len(body) // 2) + body)
    assert size(areas.load_area(spark, str(tmp_path / "a.shp"))) == 64
    (tmp_path / "none.geojson").write_text('{"type": "Point", "coordinates": [1, 2]}')
    with pytest.raises(ValueError):
        areas.load_area(spark, str(tmp_path / "none.geojson"))
    assert C.to_wkt(areas.load_area(spark, str(wkt))).startswith("MULTIPOLYGON(((")


def test_shapefile_where(spark, tmp_path):
    """Records chosen by the columns of the .dbf, by a predicate and by a whole SELECT."""
    import struct

    from mapforge.geometry import planar
    from mapforge.sources.areas import load_area

    shapes = b""
    for i, x in enumerate((0.0, 10.0, 20.0)):
        points = [(x, 0.0), (x, 1.0 + i), (x + 1.0, 1.0 + i), (x + 1.0, 0.0), (x, 0.0)]
        body = struct.pack("<i4d2ii", 5, x, 0.0, x + 1, 1.0 + i, 1, 5, 0) + b"".join(struct.pack("<2d", *p) for p in points)
        shapes += struct.pack(">2i", i + 1, len(body) // 2) + body
    (tmp_path / "land.shp").write_bytes(struct.pack(">i", 9994) + bytes(96) + shapes)
    field = lambda name, kind, size, decimals: name.encode().ljust(11, b"\0") + kind + bytes(4) + bytes([size, decimals]) + bytes(14)
    fields = field("NAME", b"C", 6, 0) + field("POP", b"N", 5, 0) + field("OK", b"L", 1, 0) + b"\r"
    rows = b" one      10T two        F three    30T"
    (tmp_path / "land.dbf").write_bytes(struct.pack("<4BIHH", 3, 26, 1, 1, 3, 32 + len(fields), 13) + bytes(20) + fields + rows)
    at = str(tmp_path / "land.shp")
    area = lambda where: round(planar.area(load_area(spark, at, where)), 9)
    assert (area(None), area("POP > 5"), area("NAME = 'two'"), area("POP IS NULL OR OK AND POP < 20"), area("SELECT * FROM land WHERE OK")) == (6.0, 4.0, 2.0, 3.0, 4.0)
