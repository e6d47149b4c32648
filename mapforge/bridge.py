"""Registered queries: element tables derived from the driver's tables, operators on them, and the same in plain SQL.

The SQL that makes the elements is one text for Spark and DuckDB; what an operator does is stated a
second time, independently, in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .defaults import MAPPING
from .functions import fields as E
from .functions import geo
from .geometry import planar
from .mapping import node_tags, relation_tags, routes, way_tags
from .operators import clip, derived, multipolygon
from .operators import elements as O

NODES = """SELECT c_custkey AS osm_id,
  CASE c_custkey % 7 WHEN 0 THEN 'city' WHEN 1 THEN 'town' WHEN 2 THEN 'village' WHEN 3 THEN 'hamlet' WHEN 4 THEN 'suburb' WHEN 5 THEN 'unknown' END AS place,
  CASE WHEN c_custkey % 11 = 0 THEN 'fixme' WHEN c_custkey % 13 = 0 THEN 'No Name' WHEN c_custkey % 17 <> 0 THEN c_name END AS name,
  CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey * 17 AS STRING) WHEN 1 THEN 'many' END AS population,
  CASE c_custkey % 5 WHEN 0 THEN 'bus_stop' WHEN 1 THEN 'nothing' END AS highway,
  CASE c_custkey % 6 WHEN 0 THEN 'B7' END AS ref,
  ((c_custkey * 7919) % 36000) / 100.0e0 - 180 AS lon, ((c_custkey * 104729) % 17000) / 100.0e0 - 85 AS lat
FROM customer"""
WAYS = """SELECT o_orderkey AS osm_id,
  CASE o_orderkey % 10 WHEN 0 THEN 'motorway' WHEN 1 THEN 'secondary' WHEN 2 THEN 'track' WHEN 3 THEN 'footway' WHEN 4 THEN 'residential' WHEN 5 THEN 'unknown' END AS highway,
  CASE o_orderkey % 9 WHEN 0 THEN 'tram' WHEN 1 THEN 'station' END AS railway,
  CASE o_orderkey % 8 WHEN 0 THEN 'park' WHEN 1 THEN 'farm' WHEN 2 THEN 'water' END AS landuse,
  CASE WHEN o_orderkey % 12 = 0 THEN o_orderpriority END AS building,
  CASE o_orderkey % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no' END AS tunnel,
  CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' END AS bridge,
  CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '-1' WHEN 2 THEN 'no' END AS oneway,
  CASE o_orderkey % 14 WHEN 0 THEN 'yes' END AS area,
  CASE o_orderkey % 3 WHEN 0 THEN '2' WHEN 1 THEN 'x' END AS layer,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS name
FROM orders"""
RELATIONS = """SELECT CAST(s_suppkey AS BIGINT) AS osm_id,
  CASE s_suppkey % 5 WHEN 0 THEN 'multipolygon' WHEN 1 THEN 'boundary' WHEN 2 THEN 'route' WHEN 3 THEN 'land_area' END AS type,
  CASE s_suppkey % 4 WHEN 0 THEN 'park' WHEN 1 THEN 'nothing' END AS landuse,
  CASE s_suppkey % 3 WHEN 0 THEN 'administrative' WHEN 1 THEN 'unknown' END AS boundary,
  CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 9 AS STRING) END AS admin_level,
  s_name AS name
FROM supplier"""
COORDS = "SELECT p_partkey AS osm_id, ((p_partkey * 7919) % 36000) / 100.0e0 - 180 AS lon, ((p_partkey * 104729) % 17000) / 100.0e0 - 85 AS lat FROM part WHERE p_partkey % 97 <> 0"
REFS = "SELECT l_orderkey AS way, l_partkey AS ref, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem"

JUNK = ", ".join(f"'{j}'" for j in E.JUNK_NAMES)
HIGHWAYS = "'motorway', 'secondary', 'track', 'footway', 'residential'"

#: The element tables after the tag filter, in SQL.
F_NODES = f"""n0 AS (SELECT osm_id, lon, lat, name, population, ref, CASE WHEN place <> 'unknown' THEN place END AS place, CASE WHEN highway = 'bus_stop' THEN highway END AS highway FROM ({NODES}) e),
  nodes AS (SELECT osm_id, lon, lat, place, highway, population, ref, CASE WHEN coalesce(place, highway, population, ref) IS NOT NULL THEN name END AS name FROM n0)"""
F_WAYS = f"""w0 AS (SELECT osm_id, name, tunnel, bridge, oneway, area, building, CASE WHEN highway IN ({HIGHWAYS}) THEN highway END AS highway, railway, CASE WHEN landuse IN ('park', 'farm') THEN landuse END AS landuse FROM ({WAYS}) e),
  ways AS (SELECT osm_id, highway, railway, landuse, building, tunnel, bridge, oneway, area, CASE WHEN coalesce(highway, railway, landuse, building, tunnel, bridge, oneway, area) IS NOT NULL THEN name END AS name FROM w0)"""
LINES = """lines AS (SELECT osm_id, 'motorways' AS tbl, 'highway' AS k, highway AS v FROM ways WHERE highway = 'motorway'
  UNION ALL SELECT osm_id, 'mainroads', 'highway', highway FROM ways WHERE highway = 'secondary'
  UNION ALL SELECT osm_id, 'minorroads', 'highway', highway FROM ways WHERE highway IN ('track', 'footway', 'residential')
  UNION ALL SELECT osm_id, 'railways', 'railway', railway FROM ways WHERE railway = 'tram')"""
AREAS = """areas AS (SELECT osm_id, 'buildings' AS tbl, 'building' AS k, building AS v FROM ways WHERE building IS NOT NULL
  UNION ALL SELECT osm_id, 'landusages', 'landuse', landuse FROM ways WHERE landuse IS NOT NULL
  UNION ALL SELECT osm_id, 'landusages', 'highway', highway FROM ways WHERE highway = 'footway' AND landuse IS NULL
  UNION ALL SELECT osm_id, 'transport_areas', 'railway', railway FROM ways WHERE railway = 'station')"""
S_NAME = f"CASE WHEN lower(name) IN ({JUNK}) THEN '' ELSE name END"
S_YES = "CAST(CASE WHEN coalesce(lower(trim({0})), 'no') IN ('false', 'no', '0', 'undefined') THEN 0 ELSE 1 END AS SMALLINT)"
S_RANK = "CASE {0} WHEN 'residential' THEN 3 WHEN 'secondary' THEN 5 WHEN 'motorway' THEN 9 ELSE CASE WHEN railway IS NOT NULL THEN 7 ELSE 0 END END"
S_Z = f"CAST({S_RANK.format('v')} - 10 * {S_YES.format('tunnel')} + 10 * {S_YES.format('bridge')} AS SMALLINT)"
S_ONEWAY = "CAST(CASE lower(trim(oneway)) WHEN 'yes' THEN 1 WHEN 'true' THEN 1 WHEN '1' THEN 1 WHEN '-1' THEN -1 ELSE 0 END AS SMALLINT)"


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for t in ("customer", "orders", "supplier", "part", "lineitem"):
        if f"FROM {t}" in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out to all cores before each of them takes its time in Python: a table of short rows is read by a task or two."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def _tagged(df: DataFrame, plain: tuple[str, ...] = ("osm_id", "lon", "lat")) -> DataFrame:
    """Columns to a tags map without nulls."""
    keys = [c for c in df.columns if c not in plain]
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in keys])
    return df.select(*[c for c in plain if c in df.columns], F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("tags"))


def _flat(df: DataFrame, *keys: str) -> DataFrame:
    return df.select("osm_id", *[F.try_element_at(F.col("tags"), F.lit(k)).alias(k) for k in keys])


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, NODES)).withColumn("tags", node_tags(F.col("tags"), MAPPING))


def _ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, WAYS)).withColumn("tags", way_tags(F.col("tags"), MAPPING))


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, RELATIONS)).withColumn("tags", relation_tags(F.col("tags"), MAPPING))


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ways (osm_id, refs): parts of an order by line; every third is closed."""
    items = _view(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
    refs = items.groupBy(F.col("l_orderkey").alias("osm_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("p"))
    line = F.col("p.l_partkey")
    return refs.select("osm_id", F.when(F.col("osm_id") % 3 == 0, F.concat(line, F.slice(line, 1, 1))).otherwise(line).alias("refs"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.resolve(_refs(spark, sf_dir), _view(spark, sf_dir, COORDS))


#: The same in SQL: (osm_id, n, first, pos, lon, lat) of the vertices of complete ways.
S_LINES = f"""coords AS ({COORDS}), refs AS ({REFS}),
  open AS (SELECT way, pos, ref FROM refs UNION ALL SELECT way, n + 1, ref FROM refs WHERE pos = 1 AND way % 3 = 0),
  v AS (SELECT way AS osm_id, pos, ref, lon, lat, count(*) OVER (PARTITION BY way) AS n, count(lon) OVER (PARTITION BY way) AS known FROM open LEFT JOIN coords ON ref = coords.osm_id),
  vertices AS (SELECT osm_id, pos, lon, lat, n FROM v WHERE n = known)"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = MAPPING.table(name)
    base = _nodes(spark, sf_dir) if spec.kind == "point" else _ways(spark, sf_dir)
    return O.features(O.routed(base, MAPPING, spec.kind), spec, MAPPING.default_name)


def _routes_of(df: DataFrame, *kinds: str) -> DataFrame:
    return O.routed(df, MAPPING, *kinds).select("osm_id", F.col("table").alias("tbl"), F.col("key").alias("k"), F.col("value").alias("v"))


def _with(tags: Column) -> E.Row:
    return E.Row(tags, F.lit("highway"), F.try_element_at(tags, F.lit("highway")))


def _field(base: Callable[[SparkSession, str], DataFrame], f: E.Field, out: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: base(s, d).select("osm_id", f.expr(_with(F.col("tags"))).alias(out))


def _raw_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, NODES))


def _raw_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, WAYS))


def _raw_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(_view(spark, sf_dir, RELATIONS))


def footway_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ways routed to lines and to polygons; of the result, the footways."""
    ways = _ways(spark, sf_dir)
    both = O.routed(ways, MAPPING, "line").unionByName(O.routed(ways, MAPPING, "polygon"))
    return both.where(F.try_element_at(F.col("tags"), F.lit("highway")) == "footway").select("osm_id", F.col("table").alias("tbl"), F.col("key").alias("k"), F.col("value").alias("v"))


def mercator_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = O.mercator(F.col("lon"), F.col("lat"))
    return _view(spark, sf_dir, NODES).select("osm_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


def pseudo_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = _lines(spark, sf_dir).where(O.closed(F.col("line")))
    row = E.Row(F.lit(None), F.lit(None), F.lit(None), O.ring_area(F.col("line")), O.mid_latitude(F.col("line")))
    return rings.select("osm_id", F.round(E.PseudoArea().expr(row) / 1e6, 2).alias("area"))


def way_closed_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return _lines(spark, sf_dir).where(O.closed(line)).select("osm_id", F.size(line).cast("long").alias("n"), F.round(O.ring_area(line), 3).alias("area"))


def way_coords_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("osm_id", F.size("line").cast("long").alias("n"), F.round(F.aggregate("line", F.lit(0.0), lambda t, p: t + p["lon"]), 4).alias("lon"), F.round(F.element_at("line", -1)["lat"], 4).alias("last_lat"))


def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = _lines(spark, sf_dir).where(O.valid_line(F.col("line"))).select("osm_id", F.posexplode(O.split_line(F.col("line"), 4)).alias("part", "piece"))
    return pieces.select("osm_id", F.col("part").cast("long").alias("part"), F.size("piece").cast("long").alias("n"), F.round(F.get("piece", F.lit(0))["lon"], 4).alias("first_lon"))


def inserted_ways_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    ways = _ways(spark, sf_dir).withColumn("routes", routes(F.col("tags"), MAPPING.rules("polygon")))
    rels = _relations(spark, sf_dir).withColumn("routes", routes(F.col("tags"), MAPPING.rules("polygon")))
    # A relation's members: the orders whose key ends in its own.
    members = _view(spark, sf_dir, "SELECT o_orderkey, o_orderkey % 100 AS rel FROM orders").groupBy("rel").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("ref"), F.lit("way").alias("type"), F.lit("outer").alias("role"))).alias("members"))
    rels = rels.join(members, F.col("osm_id") == F.col("rel"))
    left = O.not_inserted(_ways(spark, sf_dir), O.inserted_ways(rels, ways))
    return _routes_of(left, "polygon")


def merge_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every way in two extracts, the later without odd ones' names and with another oneway."""
    first = _raw_ways(spark, sf_dir).withColumn("file", F.lit(0))
    later = first.where("osm_id % 2 = 0").withColumn("file", F.lit(1)).withColumn("tags", F.map_from_arrays(F.array(F.lit("oneway"), F.lit("lanes")), F.array(F.lit("yes"), F.lit("2"))))
    return _flat(O.merge_tags(first.unionByName(later), "file"), "oneway", "lanes", "highway")


def merge_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _view(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
    member = F.struct(F.col("l_partkey").alias("ref"), F.lit("way").alias("type"), F.col("l_suppkey").cast("string").alias("role"))
    rows = items.groupBy(F.col("l_orderkey").alias("osm_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", member.alias("m")))).alias("all"))
    merged = rows.select("osm_id", O.merge_members(F.col("all.m")).alias("m"))
    return merged.select("osm_id", F.size("m").cast("long").alias("n"), F.get("m", F.lit(0))["ref"].alias("first_ref"), F.element_at("m", -1)["ref"].alias("last_ref"))


def relation_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations whose member ways are all there with all their vertices: members and vertices."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    lines = _lines(spark, sf_dir).withColumn("tags", none)
    member = F.struct(F.col("ref"), F.lit("way").alias("type"), F.lit("").alias("role"))
    rels = _view(spark, sf_dir, "SELECT o_orderkey AS ref, o_orderkey % 5000 AS osm_id FROM orders").groupBy("osm_id").agg(F.collect_list(member).alias("members"))
    got = multipolygon.members_with_lines(rels.withColumn("tags", none), lines).where(F.forall("members", lambda m: m["refs"].isNotNull()))
    vertices = F.aggregate("members", F.lit(0).cast("long"), lambda t, m: t + F.size(m["lon"]))
    return got.select("osm_id", F.size("members").cast("long").alias("members"), vertices.alias("vertices"))


def relation_tags_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every relation with one ring, whose tags count where it has but a name of its own."""
    n = F.col("osm_id") * 4
    base = _raw_relations(spark, sf_dir)
    ring = F.map_from_arrays(F.array(F.lit("natural"), F.lit("name")), F.array(F.lit("water"), F.lit("ring")))
    corners = F.array(*[F.struct((n + i).alias("osm_id"), F.lit(float(x)).alias("lon"), F.lit(float(y)).alias("lat")) for i, (x, y) in enumerate([(0, 0), (1, 0), (1, 1), (0, 1)])])
    ways = base.select("osm_id", ring.alias("tags"), F.array(n, n + 1, n + 2, n + 3, n).alias("refs"))
    member = F.array(F.struct(F.col("osm_id").alias("ref"), F.lit("way").alias("type"), F.lit("").alias("role")))
    built = multipolygon.assembled(base.withColumn("members", member), ways, base.select(F.inline(corners)))
    return _flat(built.select("osm_id", "tags"), "name", "natural", "landuse", "boundary")


def routes_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _ways(spark, sf_dir).select("osm_id", routes(F.col("tags"), MAPPING.rules("polygon")).alias("a"))
    park = F.array(F.struct(F.lit("landusages").alias("table"), F.lit("landuse").alias("key"), F.lit("park").alias("value")))
    return w.select("osm_id", F.arrays_overlap("a", park).cast("int").alias("shared"))


def union_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ways are read, filtered and routed once; a row's columns are those of its own table."""
    view = next(u for u in MAPPING.unions if u.name == "roads")
    specs = [MAPPING.table(t) for t in view.tables]
    return O.union_rows(O.routed(_ways(spark, sf_dir), MAPPING, "line"), specs, dict(view.fields), MAPPING.default_name).withColumnRenamed("class", "cls")


def dict_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = O.routed(_ways(spark, sf_dir), MAPPING, "line")
    rows = routed.select("osm_id", F.lit("LINESTRING").alias("geom_type"), "table", F.map_from_arrays(F.array("key"), F.array("value")).alias("fields"))
    out = O.documents(rows)
    return out.select("osm_id", "geom_type", F.array_join("tables", ",").alias("tables"), F.try_element_at("fields", F.lit("highway")).alias("highway"), F.try_element_at("fields", F.lit("railway")).alias("railway"))


def clip_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _view(spark, sf_dir, NODES).select("osm_id", geo.point("lon", "lat").alias("geometry"))
    inside = clip.limited(points, clip.limit_parts(spark, ("Polygon", planar.box(-10, 0, 30.5, 60))), ["osm_id"]).withColumn("b", geo.st_bounds("geometry"))
    return inside.select("osm_id", F.round("b.minx", 4).alias("lon"), F.round("b.miny", 4).alias("lat"))


def generalized_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    # The condition is on the area itself; rounded first, one of 5000.0003 would not hold.
    rings = _lines(spark, sf_dir).where(O.closed(line)).select("osm_id", O.ring_area(line).alias("area"), geo.ring("line").alias("geometry"))
    return derived.generalized(rings, 0.0, "area > 5000").select("osm_id", F.round("area", 3).alias("area"))


def tile_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(O.tile_boxes((-1, 1, 0.49, 1.51), 0.5), "x0 double, y0 double, x1 double, y1 double")


def estimate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of three files made here, of so many lines as there are orders, customers and parts."""
    from .imports import scratch

    sizes = {}
    for table, ending in (("orders", ".osm.bz2"), ("customer", ".pbf"), ("part", ".osm")):
        path = scratch(spark, table)
        spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.lit("x" * 399).alias("value")).write.text(path)
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        sizes[path + ending] = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    got = O.estimate_records(sizes)
    return spark.createDataFrame([tuple(got.values())], "coords long, nodes long, ways long, relations long")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tag_filter_nodes": lambda s, d: _flat(_nodes(s, d), "place", "highway", "population", "ref", "name"),
    "tag_filter_ways": lambda s, d: _flat(_ways(s, d), "highway", "railway", "landuse", "building", "tunnel", "bridge", "oneway", "area", "layer", "name"),
    "tag_filter_relations": lambda s, d: _flat(_relations(s, d), "type", "landuse", "boundary", "admin_level", "name"),
    "route_points": lambda s, d: _routes_of(_nodes(s, d), "point"),
    "route_lines": lambda s, d: _routes_of(_ways(s, d), "line"),
    "route_polygons_first_key_wins": lambda s, d: _routes_of(_ways(s, d), "polygon"),
    "route_wildcard": lambda s, d: _routes_of(_ways(s, d), "polygon").where("tbl = 'buildings'"),
    "footway_two_tables": footway_two_tables,
    "places_table": lambda s, d: _table(s, d, "places"),
    "transport_points_table": lambda s, d: _table(s, d, "transport_points"),
    "motorways_table": lambda s, d: _table(s, d, "motorways"),
    "railways_table": lambda s, d: _table(s, d, "railways"),
    "field_filter_area": lambda s, d: _table(s, d, "minorroads").select("osm_id", "type"),
    "field_name": _field(_raw_nodes, E.Name(), "name"),
    "field_localized": _field(_raw_nodes, E.LocalizedName(choices=("ref", "name")), "name"),
    "field_bool": _field(_raw_ways, E.Bool("tunnel"), "tunnel"),
    "field_bool_inverted": _field(_raw_ways, E.Bool("bridge", default=False), "bridge"),
    "field_direction": _field(_raw_ways, E.Direction("oneway"), "oneway"),
    "field_integer": _field(_raw_nodes, E.Integer("population"), "population"),
    "field_oneofint": lambda s, d: _raw_relations(s, d).where(~E.OneOfInt("admin_level", tuple("123456")).drops(_with(F.col("tags")))).select("osm_id", E.OneOfInt("admin_level", tuple("123456")).expr(_with(F.col("tags"))).alias("admin_level")),
    "field_zorder": lambda s, d: _raw_nodes(s, d).select("osm_id", E.ZOrder("z", ("city", "town", "village")).expr(E.Row(F.col("tags"), F.lit("place"), F.try_element_at(F.col("tags"), F.lit("place")))).alias("z")),
    "field_way_zorder": _field(_raw_ways, E.WayZOrder(), "z_order"),
    "way_coords_complete": way_coords_complete,
    "way_closed_polygons": way_closed_polygons,
    "pseudo_area": pseudo_area,
    "line_split": line_split,
    "inserted_ways_antijoin": inserted_ways_antijoin,
    "relation_members": relation_members,
    "relation_tags_fallback": relation_tags_fallback,
    "routes_overlap": routes_overlap,
    "merge_members": merge_members,
    "merge_tags": merge_tags,
    "mercator_points": mercator_points,
    "clip_points": clip_points,
    "tile_bbox": tile_bbox,
    "union_roads": union_roads,
    "generalized_where": generalized_where,
    "dict_documents": dict_documents,
    "estimate_records": estimate_records,
}

_PER_LINE = "(SELECT osm_id, n, list(lon ORDER BY pos) AS lons, list(lat ORDER BY pos) AS lats FROM vertices GROUP BY osm_id, n)"
_RINGS = f"""rings AS (SELECT osm_id, n, abs(list_sum(list_transform(range(1, n), lambda i: lons[i] * lats[i + 1] - lons[i + 1] * lats[i]))) / 2 AS area,
  list_min(lats) + abs(list_max(lats) - list_min(lats)) / 2 AS mid FROM {_PER_LINE} WHERE n >= 4 AND lons[1] = lons[n] AND lats[1] = lats[n])"""


def _road(name: str, tbl: str, with_rail: bool = False) -> str:
    extra = "CAST(NULL AS STRING) AS ref, " if not with_rail else ""
    oneway = f"{S_ONEWAY} AS oneway, " if not with_rail else ""
    keep = "" if with_rail else f" AND {S_YES.format('area')} = 0"
    return f"SELECT ways.osm_id, {S_NAME} AS name, v AS type, {S_YES.format('tunnel')} AS tunnel, {S_YES.format('bridge')} AS bridge, {oneway}{extra}{S_Z} AS z_order{name} FROM lines JOIN ways ON lines.osm_id = ways.osm_id WHERE tbl = '{tbl}'{keep}"


_UNION = " UNION ALL ".join(
    f"SELECT osm_id, name, bridge, {'CAST(NULL AS STRING) AS ref' if t != 'railways' else 'CAST(NULL AS STRING) AS ref'}, tunnel, {'oneway' if t != 'railways' else 'CAST(0 AS SMALLINT) AS oneway'}, z_order, type, '{t}' AS cls FROM ({_road('', t, t == 'railways')}) x"
    for t in ("motorways", "mainroads", "minorroads", "railways")
)

ORACLES: dict[str, str] = {
    "tag_filter_nodes": f"WITH {F_NODES} SELECT osm_id, place, highway, population, ref, name FROM nodes",
    "tag_filter_ways": f"WITH {F_WAYS} SELECT osm_id, highway, railway, landuse, building, tunnel, bridge, oneway, area, CAST(NULL AS STRING) AS layer, name FROM ways",
    "tag_filter_relations": f"""WITH r AS ({RELATIONS}), k AS (SELECT *, CASE WHEN landuse = 'park' THEN landuse END AS l2, CASE WHEN boundary = 'administrative' THEN boundary END AS b2 FROM r),
        s AS (SELECT *, type IN ('multipolygon', 'boundary', 'land_area') AND NOT (type = 'boundary' AND boundary IS NULL)
          AND NOT ((landuse IS DISTINCT FROM l2 OR boundary IS DISTINCT FROM b2) AND l2 IS NULL AND b2 IS NULL AND admin_level IS NULL) AS ok FROM k)
        SELECT osm_id, CASE WHEN ok THEN type END AS type, CASE WHEN ok THEN l2 END AS landuse, CASE WHEN ok THEN b2 END AS boundary, CASE WHEN ok THEN admin_level END AS admin_level, CASE WHEN ok THEN name END AS name FROM s""",
    "route_points": f"WITH {F_NODES} SELECT osm_id, 'places' AS tbl, 'place' AS k, place AS v FROM nodes WHERE place IS NOT NULL UNION ALL SELECT osm_id, 'transport_points', 'highway', highway FROM nodes WHERE highway IS NOT NULL",
    "route_lines": f"WITH {F_WAYS}, {LINES} SELECT osm_id, tbl, k, v FROM lines",
    "route_polygons_first_key_wins": f"WITH {F_WAYS}, {AREAS} SELECT osm_id, tbl, k, v FROM areas",
    "route_wildcard": f"WITH {F_WAYS}, {AREAS} SELECT osm_id, tbl, k, v FROM areas WHERE tbl = 'buildings'",
    "footway_two_tables": f"WITH {F_WAYS}, {LINES}, {AREAS} SELECT osm_id, tbl, k, v FROM lines WHERE osm_id % 10 = 3 UNION ALL SELECT osm_id, tbl, k, v FROM areas WHERE osm_id % 10 = 3",
    "places_table": f"""WITH {F_NODES} SELECT osm_id, {S_NAME} AS name, place AS type, CAST(CASE place WHEN 'city' THEN 5 WHEN 'town' THEN 4 WHEN 'village' THEN 3 WHEN 'hamlet' THEN 2 WHEN 'suburb' THEN 1 ELSE 0 END AS SMALLINT) AS z_order,
        TRY_CAST(population AS INTEGER) AS population FROM nodes WHERE place IS NOT NULL""",
    "transport_points_table": f"WITH {F_NODES} SELECT osm_id, {S_NAME} AS name, highway AS type, ref FROM nodes WHERE highway IS NOT NULL",
    "motorways_table": f"WITH {F_WAYS}, {LINES} {_road('', 'motorways')}",
    "railways_table": f"WITH {F_WAYS}, {LINES} {_road('', 'railways', True)}",
    "field_filter_area": f"WITH {F_WAYS}, {LINES} SELECT lines.osm_id, v AS type FROM lines JOIN ways ON lines.osm_id = ways.osm_id WHERE tbl = 'minorroads' AND (area IS NULL OR area <> 'yes')",
    "field_name": f"SELECT osm_id, {S_NAME} AS name FROM ({NODES}) e",
    "field_localized": f"SELECT osm_id, CASE WHEN ref IS NOT NULL THEN ref WHEN name IS NULL OR lower(name) IN ({JUNK}) THEN '' ELSE name END AS name FROM ({NODES}) e",
    "field_bool": f"SELECT osm_id, CAST(CASE WHEN tunnel = ' Yes' THEN 1 ELSE 0 END AS SMALLINT) AS tunnel FROM ({WAYS}) e",
    "field_bool_inverted": f"SELECT osm_id, CAST(CASE WHEN bridge = 'FALSE' THEN 1 ELSE 0 END AS SMALLINT) AS bridge FROM ({WAYS}) e",
    "field_direction": f"SELECT osm_id, CAST(CASE oneway WHEN '1' THEN 1 WHEN '-1' THEN -1 ELSE 0 END AS SMALLINT) AS oneway FROM ({WAYS}) e",
    "field_integer": f"SELECT osm_id, TRY_CAST(population AS INTEGER) AS population FROM ({NODES}) e",
    "field_oneofint": f"SELECT osm_id, CAST(admin_level AS SMALLINT) AS admin_level FROM ({RELATIONS}) e WHERE admin_level IN ('1', '2', '3', '4', '5', '6')",
    "field_zorder": f"SELECT osm_id, CAST(CASE place WHEN 'city' THEN 2 WHEN 'town' THEN 1 ELSE 0 END AS SMALLINT) AS z FROM ({NODES}) e",
    "field_way_zorder": f"SELECT osm_id, CAST(CASE WHEN layer = '2' THEN 20 ELSE 0 END + {S_RANK.format('highway')} - CASE WHEN tunnel = ' Yes' THEN 10 ELSE 0 END + CASE WHEN bridge = 'true' THEN 10 ELSE 0 END AS SMALLINT) AS z_order FROM ({WAYS}) e",
    "way_coords_complete": f"WITH {S_LINES} SELECT osm_id, n, round(sum(lon), 4) AS lon, round(max_by(lat, pos), 4) AS last_lat FROM vertices GROUP BY osm_id, n",
    "way_closed_polygons": f"WITH {S_LINES}, {_RINGS} SELECT osm_id, n, round(area, 3) AS area FROM rings",
    "pseudo_area": f"WITH {S_LINES}, {_RINGS} SELECT osm_id, CASE WHEN area > 0 THEN round(pow(sqrt(area * cos(radians(mid))) * (40075160.0e0 / 360), 2) / 1e6, 2) END AS area FROM rings",
    "line_split": f"""WITH {S_LINES}, l AS (SELECT *, CASE WHEN n > 4 THEN CAST(floor(n / ceil(n / 4.0e0)) AS BIGINT) ELSE n END AS step FROM {_PER_LINE} WHERE n >= 2 AND NOT (n = 2 AND lons[1] = lons[2] AND lats[1] = lats[2])),
        s AS (SELECT *, unnest(CASE WHEN n > 4 THEN range(1, n, step) ELSE [1] END) AS i FROM l)
        SELECT osm_id, CASE WHEN n > 4 THEN (i - 1) // step ELSE 0 END AS part, CASE WHEN n > 4 THEN least(step + 1, n - i + 1) ELSE n END AS n, round(lons[i], 4) AS first_lon FROM s""",
    "inserted_ways_antijoin": f"""WITH {F_WAYS}, {AREAS}, r AS ({RELATIONS}), park AS (SELECT osm_id FROM r WHERE type IN ('multipolygon', 'boundary', 'land_area') AND NOT (type = 'boundary' AND boundary IS NULL) AND landuse = 'park'),
        gone AS (SELECT o_orderkey AS osm_id FROM orders JOIN park ON o_orderkey % 100 = park.osm_id JOIN areas ON areas.osm_id = o_orderkey WHERE areas.tbl = 'landusages' AND areas.k = 'landuse' AND areas.v = 'park')
        SELECT osm_id, tbl, k, v FROM areas WHERE osm_id NOT IN (SELECT osm_id FROM gone)""",
    "relation_members": f"""WITH {S_LINES}, whole AS (SELECT osm_id, max(n) AS n FROM vertices GROUP BY osm_id)
        SELECT o_orderkey % 5000 AS osm_id, count(*) AS members, CAST(sum(n) AS BIGINT) AS vertices FROM orders LEFT JOIN whole ON osm_id = o_orderkey GROUP BY 1 HAVING count(*) = count(n)""",
    "relation_tags_fallback": f"SELECT osm_id, CASE WHEN coalesce(landuse, boundary, admin_level) IS NULL THEN 'ring' ELSE name END AS name, CASE WHEN coalesce(landuse, boundary, admin_level) IS NULL THEN 'water' END AS \"natural\", landuse, boundary FROM ({RELATIONS}) e",
    "routes_overlap": f"WITH {F_WAYS} SELECT osm_id, CASE WHEN landuse = 'park' THEN 1 ELSE 0 END AS shared FROM ways",
    "merge_members": """WITH s AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
        f AS (SELECT l_orderkey, l_partkey, min(i) AS i FROM s GROUP BY ALL) SELECT l_orderkey AS osm_id, count(*) AS n, min_by(l_partkey, i) AS first_ref, max_by(l_partkey, i) AS last_ref FROM f GROUP BY 1""",
    "merge_tags": f"SELECT osm_id, CASE WHEN osm_id % 2 = 0 THEN 'yes' ELSE oneway END AS oneway, CASE WHEN osm_id % 2 = 0 THEN '2' END AS lanes, highway FROM ({WAYS}) e WHERE osm_id % 2 = 0 OR coalesce(highway, railway, landuse, building, tunnel, bridge, oneway, area, layer, name) IS NOT NULL",
    "mercator_points": f"SELECT osm_id, round(radians(lon) * 6378137.0e0, 3) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0e0, 3) AS y FROM ({NODES}) e",
    "clip_points": f"SELECT osm_id, round(lon, 4) AS lon, round(lat, 4) AS lat FROM ({NODES}) e WHERE lon >= -10 AND lon <= 30.5 AND lat >= 0 AND lat <= 60",
    "tile_bbox": "SELECT CAST(x AS DOUBLE) / 2 AS x0, CAST(y AS DOUBLE) / 2 AS y0, CAST(x + 1 AS DOUBLE) / 2 AS x1, CAST(y + 1 AS DOUBLE) / 2 AS y1 FROM range(-2, 1) a(x), range(2, 4) b(y)",
    "union_roads": f"WITH {F_WAYS}, {LINES} {_UNION}",
    "generalized_where": f"WITH {S_LINES}, {_RINGS} SELECT osm_id, round(area, 3) AS area FROM rings WHERE area > 5000",
    "dict_documents": f"WITH {F_WAYS}, {LINES} SELECT osm_id, 'LINESTRING' AS geom_type, string_agg(tbl, ',' ORDER BY tbl) AS tables, max(CASE WHEN k = 'highway' THEN v END) AS highway, max(CASE WHEN k = 'railway' THEN v END) AS railway FROM lines GROUP BY osm_id",
    "estimate_records": "SELECT c AS coords, c // 50 AS nodes, c // 7 AS ways, c // 1000 AS relations FROM (SELECT CAST(2 * (11 * (SELECT count(*) FROM orders) + 15 * (SELECT count(*) FROM customer) + (SELECT count(*) FROM part)) AS BIGINT) AS c) q",
}
