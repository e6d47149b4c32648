"""A small extract from file to production tables."""

import pytest

from mapforge import catalog, engine
from mapforge.cli import main
from mapforge.defaults import MAPPING
from mapforge.functions import geo
from mapforge.geometry import codec as C
from mapforge.geometry import planar as P
from mapforge.mapping import ANY, Generalized, MappingSet, Repair, TableSpec, UnionView

SMALL = MappingSet(
    (TableSpec("places", "point", {"place": ("village",)}), TableSpec("roads", "line", {"highway": (ANY,)}), TableSpec("landusages", "polygon", {"landuse": ("park", "wood")})),
    (Generalized("roads_gen0", "roads_gen1", 500), Generalized("roads_gen1", "roads", 100), Generalized("land_gen", "landusages", 10)),
    (UnionView("all_roads", ("roads", "roads_gen0"), (("lanes", 1),)),),
    (Repair("land_valid", "land_gen"),),
)
PLACES = {1: (13, 47.5), 2: (0, 0), 3: (10, 0), 4: (10, 10), 5: (0, 10), 6: (2, 2), 7: (4, 2), 8: (4, 4), 9: (5, 0.0001), 10: (30, 30), 11: (31, 30), 12: (31, 31)}


def tags(**t):
    return "".join(f'<tag k="{k}" v="{v}"/>' for k, v in t.items())


def way(i, *refs, **t):
    return f'<way id="{i}">{"".join(f"<nd ref=\"{r}\"/>" for r in refs)}{tags(**t)}</way>'


@pytest.fixture
def osm(tmp_path):
    nodes = "".join(f'<node id="{i}" lon="{x}" lat="{y}">{tags(place="village", name="Foo") if i == 1 else ""}</node>' for i, (x, y) in PLACES.items())
    ways = way(1, 2, 3, 4, 5, 2, landuse="park") + way(2, 6, 7, 8, 6, landuse="water", name="lake") + way(3, 2, 9, 3, highway="road", name="b") + way(4, 10, 11, 12, 10, landuse="wood") + way(5, 2, 99, highway="road")
    relation = f'<relation id="7"><member type="way" ref="1" role="outer"/><member type="way" ref="2" role="inner"/>{tags(type="multipolygon", landuse="park", name="R")}</relation>'
    f = tmp_path / "a.osm"
    f.write_text(f'<?xml version="1.0"?><osm version="0.6">{nodes}{ways}{relation}</osm>', encoding="utf-8")
    return str(f)


def shown(df):
    return {(r["osm_id"], r["name"], r["t"]) for r in df.select("osm_id", "name", geo.as_text("geometry").alias("t")).collect()}


def staged(spark, tmp_path, osm):
    s = engine.Staging(spark, str(tmp_path / "staging"))
    s.save(engine.merged(engine.read(spark, [osm])), SMALL)
    return s


def test_tables(spark, tmp_path, osm):
    s = staged(spark, tmp_path, osm)
    with pytest.raises(FileExistsError):
        s.save(s.load(), SMALL)
    t = engine.base_tables(s.load(), SMALL)
    assert shown(t["places"]) == {(1, "Foo", "POINT(13 47.5)")}
    assert shown(t["roads"]) == {(3, "b", "LINESTRING(0 0,5 0.0001,10 0)")}
    # The park's way made the relation's polygon, with the lake as its hole; the wood stands alone.
    land = shown(t["landusages"])
    assert {(i, n, P.area(C.from_wkt(g))) for i, n, g in land} == {(7, "R", 98.0), (4, None, 0.5)}


def test_limit_split_and_projection(spark, tmp_path, osm):
    s = staged(spark, tmp_path, osm)
    t = engine.base_tables(s.load(), SMALL, engine.Options(limit=("Polygon", P.box(-1, -1, 5, 5)), max_length=2))
    assert t["places"].count() == 0
    assert {g for _, _, g in shown(t["roads"])} == {"LINESTRING(0 0,5 0.0001)"}
    assert [(i, round(P.area(C.from_wkt(g)), 9)) for i, _, g in shown(t["landusages"])] == [(7, 23.0)]
    far = engine.base_tables(s.load(), SMALL, engine.Options(srid=3857))
    assert abs(C.from_wkt(next(iter(shown(far["places"])))[2])[1][0] - 1447153.38) < 0.01


def test_merge(spark, tmp_path, osm):
    s = staged(spark, tmp_path, osm)
    later = tmp_path / "b.osm"
    later.write_text(f'<osm><node id="99" lon="-1" lat="0"/>{way(5, 99, 2, 6, highway="road", name="far")}</osm>')
    s.save(engine.merged(engine.read(spark, [str(later)])), SMALL, "merge")
    assert s.load().coords.count() == 13
    # Way 5 was 2-99 in one file and 99-2-6 in the other.
    assert "far" in {n for _, n, _ in shown(engine.base_tables(s.load(), SMALL)["roads"])}


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mf_test")
    before = spark.catalog.currentDatabase()
    yield "mf_test"
    spark.catalog.setCurrentDatabase(before)
    spark.sql("DROP DATABASE mf_test CASCADE")


def test_commands(spark, tmp_path, osm, database):
    (tmp_path / "mapping.py").write_text("from tests.test_engine import SMALL as MAPPING\n")
    cache = ["--cache-dir", str(tmp_path / "cache"), "-d", database, "-m", str(tmp_path / "mapping.py")]
    assert main([], spark) == 1 and main(["--write", "-d", "none_such"], spark) == 2
    assert main(["--read", osm, "--write", "--dry-run", *cache], spark) == 0
    assert main(["--read", osm, *cache], spark) == 2
    assert main(["--read", osm, "--overwrite-cache", "--write", "--optimize", *cache], spark) == 0
    names = lambda: {t.name for t in spark.catalog.listTables() if not t.isTemporary}
    base = {"places", "roads", "landusages", "roads_gen0", "roads_gen1", "land_gen", "all_roads"}
    assert names() == {"osm_new_" + n for n in base}
    got = {(r["osm_id"], r["class"], r["lanes"]) for r in spark.table("osm_new_all_roads").collect()}
    assert got == {(3, "roads", "1"), (3, "roads_gen1", "1")} or got == {(3, "roads", 1), (3, "roads_gen1", 1)}
    assert spark.table("osm_new_places").columns[-4:] == ["minx", "miny", "maxx", "maxy"]
    assert main(["--deploy-production-tables", *cache], spark) == 0
    assert names() == {"osm_" + n for n in base}
    with pytest.raises(RuntimeError):
        main(["--deploy-production-tables", *cache], spark)
    assert main(["--write", "--deploy-production-tables", *cache], spark) == 0
    assert names() == {"osm_" + n for n in base} | {"osm_old_" + n for n in base}
    assert main(["--recover-production-tables", *cache], spark) == 0
    assert names() == {"osm_" + n for n in base} | {"osm_new_" + n for n in base}
    assert spark.table("osm_all_roads").count() == 2
    assert main(["--deploy-production-tables", "--remove-backup-tables", *cache], spark) == 0
    assert names() == {"osm_" + n for n in base}


def test_import_computes_once(spark, tmp_path, osm):
    """With steps kept, the tables' plans build no relation and join no vertices again; without, each polygon table would."""
    s = staged(spark, tmp_path, osm)
    keep, done = s.keeper()
    steps = []

    def counted(name, df, by=None):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        steps.append((name, plan.count("MapInPandas"), plan.count("lon#") and "posexplode(refs" in plan))
        return keep(name, df, by)

    tables = engine.base_tables(s.load(), MAPPING, keep=counted)
    assert sum(n for _, n, _ in steps) == 1 and [name for name, _, joins in steps if joins] == ["lines"]
    for df in tables.values():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInPandas" not in plan and "posexplode" not in plan
    assert tables["landusages"].count() == 2
    done()


def test_rejects_documents_and_indexes(spark, tmp_path, osm, database):
    from mapforge.functions.fields import Field, String

    spark.catalog.setCurrentDatabase(database)
    twice = Field.from_function("lanes", lambda v: None if v is None else 2 * int(v), "int")
    m = MappingSet((TableSpec("roads", "line", {"highway": (ANY,)}, (String("ref", indexed=True), twice)), SMALL.table("landusages")), (Generalized("roads_gen", "roads", 0.1),))
    (tmp_path / "more.osm").write_text(f'<osm>{way(50, 2, 3, highway="x", lanes="3")}<relation id="8"><member type="way" ref="77" role=""/>{tags(type="multipolygon", landuse="park")}</relation></osm>')
    s = engine.Staging(spark, str(tmp_path / "s"))
    s.save(engine.merged(engine.read(spark, [osm, str(tmp_path / "more.osm")])), m)
    engine.write(spark, s, m, engine.Options(slow=0.0))
    assert {tuple(r) for r in s.rejects().collect()} == {("relation", 8, "missing way or vertex"), ("way", 5, "missing vertex")}
    assert {r["osm_id"] for r in s.slow_relations().collect()} == {7, 8}
    for t in ("osm_new_roads", "osm_new_roads_gen"):
        assert {r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {t}").collect() if r["key"] == "indexed"} == {'["ref"]'}
    assert {(r["osm_id"], r["lanes"]) for r in spark.table("osm_new_roads").collect()} == {(3, None), (50, 6)}
    engine.write_documents(s, m, str(tmp_path / "json"))
    got = {r["osm_id"]: r for r in spark.read.json(str(tmp_path / "json")).collect()}
    assert got[50]["geom_type"] == "LINESTRING" and got[50]["fields"]["lanes"] == "6" and got[7]["tables"] == ["landusages"]


def test_a_merge_that_broke_off_is_put_back(spark, tmp_path, osm):
    s = staged(spark, tmp_path, osm)
    (tmp_path / "staging").rename(tmp_path / "staging__previous")
    assert s.exists() and s.load().coords.count() == 12


def test_sinks_and_prefixes(spark):
    s = catalog.parse_sink("catalog://me:a%2Bb+c@host:5432/db?x=1")
    assert (s.host, s.port, s.database, s.user, s.password, s.options) == ("host", 5432, "db", "me", "a+b c", (("x", "1"),))
    p = catalog.Prefixes("osm_new", "osm", "osm_old__")
    assert p.owner("osm_new_roads") == "osm_new_" and p.owner("osm_roads") == "osm_" and p.owner("osmx") is None
    with pytest.raises(ValueError):
        catalog.Prefixes("a", "a", "b")


def test_default_mapping_derives(spark, tmp_path, osm):
    s = engine.Staging(spark, str(tmp_path / "s"))
    s.save(engine.merged(engine.read(spark, [osm])), MAPPING)
    t = engine.derived_tables(engine.base_tables(s.load(), MAPPING, engine.Options(srid=3857)), MAPPING)
    assert set(engine.union_views(t, MAPPING)) == {"roads", "roads_gen1", "roads_gen0"}
    assert t["landusages_gen0"].count() == 2 and t["landusages"].where("osm_id = 7 AND area > 0").count() == 1


def test_repair_of_a_base_table(spark, tmp_path):
    """Polygons of a base table that a Repair names are written valid, and so are those generalized from it."""
    corners = {1: (0, 0), 2: (4, 4), 3: (4, 0), 4: (0, 4)}
    nodes = "".join(f'<node id="{i}" lon="{x}" lat="{y}"/>' for i, (x, y) in corners.items())
    f = tmp_path / "bow.osm"
    f.write_text(f'<?xml version="1.0"?><osm version="0.6">{nodes}{way(1, 1, 2, 3, 4, 1, landuse="park")}</osm>', encoding="utf-8")
    mapping = MappingSet((SMALL.table("landusages"),), (Generalized("land_gen", "landusages", 0.001),), (), (Repair("land_valid", "landusages"),))
    s = engine.Staging(spark, str(tmp_path / "bow"))
    s.save(engine.merged(engine.read(spark, [str(f)])), mapping)
    assert [r["ok"] for r in engine.base_tables(s.load(), mapping)["landusages"].select(geo.st_isvalid("geometry").alias("ok")).collect()] == [False]
    names = engine.write(spark, s, mapping, p=catalog.Prefixes(new="bow_new_"))
    try:
        for name in ("bow_new_landusages", "bow_new_land_gen"):
            assert [r["ok"] for r in spark.table(name).select(geo.st_isvalid("geometry").alias("ok")).collect()] == [True]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables_are_written_at_the_same_time(spark, monkeypatch, tmp_path):
    """An import's tables, and optimize's, don't wait for one another; a failed step ends the rest."""
    import itertools
    import threading

    from mapforge import imports

    m = MappingSet(tables=tuple(TableSpec(f"t{i}", "point", {"amenity": (v,)}) for i, v in enumerate(("school", "police"))))
    staging, p = engine.Staging(spark, str(tmp_path / "staging")), catalog.Prefixes("both_new", "both_now", "both_old")
    staging.save(imports.elements(spark, "/root/testdata/sf0.001"), m)
    two, old = threading.Barrier(2, timeout=60), catalog.create

    def waits(*rest):
        two.wait()
        old(*rest)

    monkeypatch.setattr(catalog, "create", waits)
    monkeypatch.setattr(engine, "create", waits)
    try:
        assert engine.write(spark, staging, m, p=p) == ["both_new_t0", "both_new_t1"]
        assert catalog.optimize(spark, p) == ["both_new_t0", "both_new_t1"]
        assert [spark.table(f"both_new_t{i}").count() for i in range(2)] == [50, 50]
    finally:
        catalog.remove(spark, p, p.new)
    begun = itertools.count()

    def fails():
        next(begun)
        raise ValueError("no")

    with pytest.raises(ValueError):
        catalog.together(spark, [fails] * 50, threads=1)
    assert next(begun) == 1


def test_a_temporary_view_is_not_dropped(spark):
    spark.range(3).createOrReplaceTempView("kept_view")
    catalog.create(spark, "kept_view", spark.range(2).toDF("x"))
    try:
        assert spark.table("kept_view").count() == 3
    finally:
        spark.catalog.dropTempView("kept_view")
        catalog._drop(spark, "kept_view")
    assert not spark.catalog.tableExists("kept_view")
