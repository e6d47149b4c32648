"""Relations to polygons, by both ways of building them."""

import itertools

import pytest

from mapforge.geometry import codec as C
from mapforge.geometry import planar as P
from mapforge.operators import multipolygon as M


def way(i, points, refs=None, **tags):
    return M.Ring([i], refs or [i * 100 + n for n in range(len(points) - 1)] + [i * 100], [tuple(map(float, p)) for p in points], tags)


def square(i, low, high, **tags):
    return way(i, [(low, low), (high, low), (high, high), (low, high), (low, low)], **tags)


def made(ways, own=None, **options):
    polygons, tags, rings, flags = M.build(own or {"landuse": "forest"}, ways, **options)
    return P.area(C.gathered("Polygon", polygons)), tags, rings, flags


@pytest.fixture(params=["contains", "union"])
def method(request):
    return request.param


def test_holes(method):
    assert made([square(1, 0, 10, landuse="forest"), square(2, 2, 8, natural="water")], method=method)[0] == 64
    area, _, _, flags = made([square(i, 10 - n, 10 + n, **({"landuse": "forest"} if i % 2 else {"natural": "water"})) for i, n in ((1, 5), (2, 4), (3, 3), (4, 2), (5, 1))], method=method)
    assert area == 100 - 64 + 36 - 16 + 4 and flags == [True, False, True, False, True]


def test_touching(method):
    holes = [way(2, [(1, 1), (5, 1), (5, 9), (1, 9), (1, 1)]), way(3, [(5, 1), (9, 1), (9, 9), (5, 9), (5, 1)])]
    assert made([square(1, 0, 10), *holes], method=method)[0] == 36
    shells = [square(1, 0, 10), way(2, [(10, 0), (30, 0), (30, 10), (10, 10), (10, 0)]), square(3, 2, 8)]
    assert made(shells, method=method)[0] == 264


def test_broken_rings(method):
    spike = [(0, 0), (0, 10), (10, 10), (10, 0), (20, 0), (20, 10), (30, 10), (30, 0), (0, 0)]
    assert made([way(1, spike), square(2, 2, 8)], method=method)[0] == 164
    thin = [(0, 0), (0, 100), (100, 50 - 1e-5), (100, 50 + 1e-5), (0, 0)]
    assert abs(made([way(1, thin), way(2, [(10, 45), (10, 55), (20, 55), (20, 45), (10, 45)])], method=method)[0] - 4900) < 0.01


def test_chains_in_any_order_and_direction():
    corner = {1: (0, 0), 2: (10, 0), 3: (10, 10), 4: (0, 10)}
    for mask in range(16):
        for order in itertools.permutations(range(4)):
            ways = []
            for i in order:
                refs = [i + 1, (i + 1) % 4 + 1]
                refs = refs[::-1] if mask >> i & 1 else refs
                ways.append(M.Ring([i], refs, [tuple(map(float, corner[r])) for r in refs], {"a": str(i)}))
            (ring,) = M.chained(ways)
            assert ring.closed and sorted(ring.ways) == [0, 1, 2, 3] and abs(P.signed_area(ring.line)) == 100
            assert all(abs(a - b) in (1, 3) for a, b in itertools.pairwise(ring.refs))
            assert ring.tags["a"] == str(order[-1])


def test_open_and_missing():
    half = M.Ring([1], [1, 2, 3], [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])
    with pytest.raises(M.Incomplete):
        made([half])
    assert made([half, square(2, 0, 10)], partial=True)[0] == 100
    with pytest.raises(M.Incomplete):
        made([square(1, 0, 10), square(2, 1, 2)], max_rings=1)


def test_tags():
    assert made([square(1, 0, 9, landuse="park", name="x")], {"type": "multipolygon", "name": "y"})[1] == {"landuse": "park", "name": "x"}
    assert made([square(1, 0, 9, landuse="park")], {"type": "multipolygon", "name": "y", "natural": "wood"})[1] == {"natural": "wood", "name": "y"}


def test_in_spark(spark):
    coords = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 10.0, 10.0), (4, 0.0, 10.0), (5, 2.0, 2.0), (6, 4.0, 2.0), (7, 4.0, 4.0)], "osm_id long, lon double, lat double")
    ways = spark.createDataFrame([(1, {"landuse": "park"}, [1, 2, 3]), (2, {"name": "z"}, [1, 4, 3]), (3, {}, [5, 6, 7, 5]), (4, {}, [5, 99])], "osm_id long, tags map<string,string>, refs array<long>")
    member = lambda *ids: [(i, "way", "") for i in ids] + [(1, "node", "")]
    relations = spark.createDataFrame([(1, {"type": "multipolygon"}, member(1, 2, 3)), (2, {"type": "multipolygon"}, member(1, 4)), (3, {"a": "b"}, member(9))], "osm_id long, tags map<string,string>, members array<struct<ref:long,type:string,role:string>>")
    got = {r["osm_id"]: r for r in M.assembled(relations, ways, coords).collect()}
    assert got[1]["area"] == 98 and got[1]["tags"] == {"landuse": "park", "name": "z"} and got[1]["ways"] == [1, 2, 3] and got[1]["mid_lat"] == 5
    assert C.from_wkb(bytes(got[1]["geometry"]))[0] == "Polygon"
    assert got[2]["geometry"] is None and got[2]["reason"] == got[3]["reason"] == "missing way or vertex"
