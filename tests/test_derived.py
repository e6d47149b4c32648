"""Clipping, merging of extracts, generalized and repaired tables."""

import pytest
from pyspark.sql import functions as F

from mapforge.functions import geo
from mapforge.geometry import codec as C
from mapforge.geometry import planar as P
from mapforge.mapping import Generalized
from mapforge.operators import clip, derived, merging

TEN = ("Polygon", P.box(0, 0, 10, 10))


def shapes(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "osm_id long, wkt string")
    return rows.select("osm_id", F.lit("x").alias("name"), geo.from_text("wkt").alias("geometry"))


def texts(df):
    return sorted((r["osm_id"], r["t"]) for r in df.select("osm_id", geo.as_text("geometry").alias("t")).collect())


def test_clip(spark):
    rows = shapes(spark, "LINESTRING(-10 -10,20 20)", "LINESTRING(1 1,5 5,6 5)", "LINESTRING(-5 2,5 2,5 12,6 12,6 5)", "LINESTRING(-5 5,5 15)", "POINT(5 5)", "POINT(50 5)", "POLYGON((1 1,1 2,2 2,2 1,1 1))", "POLYGON((5 5,15 5,15 15,5 15,5 5))", None)
    got = texts(clip.limited(rows, clip.limit_parts(spark, TEN), ["osm_id"]))
    assert [g for g in got if g[0] in (1, 4, 6)] == [(1, "LINESTRING(1 1,5 5,6 5)"), (4, "POINT(5 5)"), (6, "POLYGON((1 1,1 2,2 2,2 1,1 1))")]
    assert {g[0] for g in got} == {0, 1, 2, 4, 6, 7} and (0, "LINESTRING(0 0,10 10)") in got and len([g for g in got if g[0] == 2]) == 2
    assert P.area(C.from_wkt(next(t for i, t in got if i == 7))) == 25


def test_near_parts_of_all_sizes(spark):
    import random

    r = random.Random(7)

    def box():
        size = r.choice([0.0, 0.003, 0.1, 0.5, 1.0, 7.0, 10.0, 60.0, 300.0])
        x, y = round(r.uniform(-180, 180), 1), round(r.uniform(-90, 90), 1)
        return x, y, x + size, y + size * r.choice([0.0, 0.1, 1.0])

    features, parts = [box() for _ in range(150)], [box() for _ in range(150)]
    names = "minx double, miny double, maxx double, maxy double"
    rows = spark.createDataFrame([(i, *b) for i, b in enumerate(features)], f"osm_id int, {names}").select("osm_id", F.struct("minx", "miny", "maxx", "maxy").alias("_b"))
    got = clip.near_parts(rows, spark.createDataFrame([(i, *b) for i, b in enumerate(parts)], f"part int, {names}"), ["osm_id"]).collect()
    want = {(i, j) for i, a in enumerate(features) for j, b in enumerate(parts) if a[0] <= b[2] and a[2] >= b[0] and a[1] <= b[3] and a[3] >= b[1]}
    assert want and len(got) == len(want) and {tuple(g) for g in got} == want
    none = rows.where("false")
    assert clip.near_parts(none, spark.createDataFrame([(1, *parts[0])], f"part int, {names}"), ["osm_id"]).count() == 0


def test_clip_by_a_cut_area(spark):
    import math

    ring = [(12 * math.cos(t / 900 * 2 * math.pi), 12 * math.sin(t / 900 * 2 * math.pi)) for t in range(900)]
    parts = clip.limit_parts(spark, ("Polygon", [ring + ring[:1]]))
    assert parts.count() > 4
    got = texts(clip.limited(shapes(spark, "LINESTRING(-20 0.5,20 0.5)", "POLYGON((-5 -5,25 -5,25 5,-5 5,-5 -5))"), parts, ["osm_id"]))
    assert [g[0] for g in got] == [0, 1] and got[1][1].startswith("POLYGON")
    want = P.area(C.gathered("Polygon", P.intersection([[ring + ring[:1]]], [P.box(-5, -5, 25, 5)])))
    assert abs(P.area(C.from_wkt(got[1][1])) - want) < 1e-6
    with pytest.raises(ValueError):
        clip.checked_wgs84(("Polygon", P.box(0, 0, 500, 1)))


def test_sequences():
    assert merging.merged_pair([1, 2, 3], [2, 3, 4]) == [1, 2, 3, 4] and merging.merged_pair([1, 2], [3]) is None
    assert merging.merged_pair([1, 2, 5], [0, 2, 3, 5]) == [1, 0, 2, 3, 5]
    assert merging.merged([[1, 2], [5, 6], [2, 3, 5]]) == [[1, 2, 3, 5, 6]] and merging.merged([[1], [2]]) == [[1], [2]]


def test_extracts(spark):
    ways = spark.createDataFrame([(1, {"a": "1", "b": "2"}, [1, 2, 3], 0), (1, {"a": "3"}, [2, 3, 4], 1), (2, {}, [1, 2], 0), (2, {}, [8, 9], 1), (3, {}, [4, 5], 0), (3, {}, [4, 5], 1)], "osm_id long, tags map<string,string>, refs array<long>, file int")
    got = {r["osm_id"]: (r["tags"], r["refs"], r["partial"]) for r in merging.merge_ways(ways, "file").collect()}
    assert got == {1: ({"a": "3", "b": "2"}, [1, 2, 3, 4], False), 2: ({}, [1, 2], True), 3: ({}, [4, 5], False)}
    points = spark.createDataFrame([(1, 1.0, 2.0, 0), (1, 3.0, 4.0, 1)], "osm_id long, lon double, lat double, file int")
    assert [tuple(r) for r in merging.merge_points(points, "file").collect()] == [(1, 3.0, 4.0)]
    relations = spark.createDataFrame([(1, {"t": "x"}, [(1, "way", "outer"), (2, "way", "")], 0), (1, {}, [(2, "node", ""), (3, "way", "")], 1)], "osm_id long, tags map<string,string>, members array<struct<ref:long,type:string,role:string>>, file int")
    row = merging.merge_relations(relations, "file").first()
    assert row["tags"] == {"t": "x"} and [m["ref"] for m in row["members"]] == [1, 2, 3] and row["members"][1]["type"] == "way"


def test_generalized_and_repaired(spark):
    rows = shapes(spark, "LINESTRING(0 0,1 0.001,2 0)", "POLYGON((0 0,0 100,100 0,100 100,0 0))", "POLYGON((0 0,5 0,5 5,0 0))", "POLYGON((0 0,1 0,0 0,0 0))")
    assert texts(derived.generalized(rows, 0.1, "ST_Area(geometry) = 0 AND ST_GeometryType(geometry) = 'LineString'")) == [(0, "LINESTRING(0 0,2 0)")]
    got = derived.repaired(rows)
    assert [i for i, _ in texts(got)] == [0, 1, 2] and got.select(F.min(geo.st_isvalid("geometry"))).first()[0]
    a, b = Generalized("a", "t", 1), Generalized("z", "a", 2)
    assert [t.name for t in derived.in_order([b, a], ["t"])] == ["a", "z"]
    with pytest.raises(ValueError):
        derived.in_order([b], ["t"])


def test_functions(spark):
    rows = shapes(spark, "POINT(13 47.5)", None)
    back = rows.select("osm_id", geo.st_transform(geo.st_transform("geometry", F.lit(4326), F.lit(3857)), F.lit(900913), F.lit(4326)).alias("g")).where("osm_id = 0").first()["g"]
    assert all(abs(a - b) < 1e-9 for a, b in zip(C.from_wkb(bytes(back))[1], (13, 47.5)))
    bad = spark.createDataFrame([(bytearray(b"\x01\x02"),), (bytearray(b""),)], "g binary")
    assert [r[0] for r in bad.select(geo.st_area("g")).collect()] == [None, None]
    cell = rows.where("osm_id = 0").select(geo.z_cell(geo.st_bounds("geometry")).alias("z")).first()["z"]
    assert 0 <= cell < 1 << 24


def test_only_invalid_polygons_are_rebuilt(spark, monkeypatch, tmp_path):
    """repair_polygons rebuilds each invalid polygon once and no valid one, and deals its rows to all cores."""
    from mapforge import shapes

    n = 600
    spark.range(1, n + 1).selectExpr("id AS c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rebuilt = spark.sparkContext.accumulator(0)
    tasks = shapes._shapes(spark, str(tmp_path), shapes.BOX_TEXT).select(F.spark_partition_id().alias("p")).distinct().count()
    old = geo._buffer

    def counted(g, width):
        rebuilt.add(1)
        return old(g, width)

    def one(g):
        import pandas as pd

        return pd.Series([b if (v := C.from_wkb(b)) is None or P.is_valid(v) else counted(v, 0.0) for b in g], dtype=object)

    assert tasks > 1
    plan = derived.repaired(shapes._shapes(spark, str(tmp_path), shapes.BOX_TEXT))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # from text, and all of the repair
    monkeypatch.setattr(geo, "mended", F.pandas_udf(one, "binary").asNondeterministic())
    rows = shapes.repair_polygons(spark, str(tmp_path)).collect()
    assert len(rows) == n and all(r["valid"] == 1 for r in rows) and rebuilt.value == n // 3
