from mapforge.defaults import MAPPING
from mapforge.functions import fields as E
from mapforge.mapping import node_tags, relation_tags, routes, way_tags
from mapforge.operators import elements as O
from mapforge.sources.xml import read_osm

XML = """<?xml version="1.0"?><osm version="0.6">
<node id="1" lat="47.5" lon="13"><tag k="place" v="village"/><tag k="name" v="Foo"/></node>
<node id="2" lat="0" lon="0"/><node id="3" lat="0" lon="1"/><node id="4" lat="1" lon="1"/>
<way id="10"><nd ref="2"/><nd ref="3"/><nd ref="4"/><nd ref="2"/><tag k="highway" v="secondary"/><tag k="railway" v="tram"/><tag k="oneway" v="1"/><tag k="name" v="roundabout"/></way>
<way id="11"><nd ref="2"/><nd ref="99"/></way>
<relation id="20"><member type="way" ref="10" role="outer"/><tag k="type" v="multipolygon"/></relation>
</osm>"""


def test_xml_to_tables(spark, tmp_path):
    (tmp_path / "a.osm").write_text(XML)
    e = read_osm(spark, str(tmp_path / "a.osm"))
    assert (e.coords.count(), e.nodes.count(), e.ways.count(), e.relations.count()) == (4, 1, 2, 1)
    nodes = e.nodes.withColumn("tags", node_tags(e.nodes["tags"], MAPPING))
    got = O.features(O.routed(nodes, MAPPING, "point"), MAPPING.table("places"), MAPPING.default_name, keep=("osm_id", "lon", "lat")).first()
    assert (got["osm_id"], got["name"], got["type"], got["lon"], got["lat"]) == (1, "Foo", "village", 13.0, 47.5)
    ways = O.resolve(e.ways.withColumn("tags", way_tags(e.ways["tags"], MAPPING)), e.coords)
    assert [r["osm_id"] for r in ways.collect()] == [10]  # a way that lacks a vertex goes
    road = O.features(O.routed(ways, MAPPING, "line"), MAPPING.table("mainroads"), MAPPING.default_name).first()
    assert list(road)[1:] == ["roundabout", "secondary", 0, 0, 1, None, 5]
    rail = O.features(O.routed(ways, MAPPING, "line"), MAPPING.table("railways"), MAPPING.default_name).first()
    assert list(rail)[1:] == ["roundabout", "tram", 0, 0, 7]
    area = ways.select(E.PseudoArea().expr(E.Row(ways["tags"], ways["tags"], ways["tags"], O.ring_area(ways["line"]), O.mid_latitude(ways["line"]))).alias("a")).first()["a"]
    assert abs(area - 6195822904.182782) < 1


def maps(spark, rows, f):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, tags map<string,string>")
    return [r["out"] for r in df.select("i", f(df["tags"]).alias("out")).orderBy("i").collect()]


def test_tag_filters(spark):
    same = {"name": "foo", "place": "village", "population": "1000"}
    assert maps(spark, [{"name": "foo"}, {"name": "foo", "place": "unknown"}, same, {"name": "a", "place": "village", "highway": "unknown"}], lambda t: node_tags(t, MAPPING)) == [{}, {}, same, {"name": "a", "place": "village"}]
    assert maps(spark, [{"name": "foo", "highway": "track", "place": "x"}, {"name": "f", "building": "any"}], lambda t: way_tags(t, MAPPING)) == [{"name": "foo", "highway": "track"}, {"name": "f", "building": "any"}]
    rel = [{"name": "f", "landuse": "farm"}, {"name": "f", "landuse": "farm", "type": "multipolygon"}, {"name": "f", "landuse": "unknown", "type": "multipolygon"}, {"name": "f", "landuse": "farm", "type": "boundary"}, {"name": "f", "boundary": "unknown", "type": "boundary"}, {"type": "multipolygon"}]
    assert maps(spark, rel, lambda t: relation_tags(t, MAPPING)) == [{}, rel[1], {}, {}, {}, rel[5]]


def test_routes(spark):
    of = lambda tags, *kinds: {(r["table"], r["key"]) for r in maps(spark, [tags], lambda t: routes(t, MAPPING.rules(*kinds)))[0]}
    assert of({"highway": "footway", "landuse": "park"}, "polygon") == {("landusages", "landuse")}
    assert of({"highway": "secondary", "railway": "tram"}, "line") == {("mainroads", "highway"), ("railways", "railway")}


def test_names(spark):
    row = lambda t: E.Row(t, t, t)
    assert maps(spark, [{"name": "fixme"}, {"name": "Foo Street"}, {"x": "y"}], lambda t: E.Name().expr(row(t))) == ["", "Foo Street", None]
    f = E.LocalizedName(choices=("name:de", "name:en", "foo"))
    assert maps(spark, [{"name": "Foo"}, {"name:de": "Foo", "name:en": "Bar"}, {"name:es": "Foo", "foo": "Bar"}], lambda t: f.expr(row(t))) == ["", "Foo", "Bar"]
