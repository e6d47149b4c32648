"""Registered queries of the whole import: files written and read back, and every declared table from made-up elements.

The elements come from the driver's tables by closed formulas, which the SQL states a second time.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, engine
from .bridge import _tagged, _view
from .defaults import MAPPING
from .functions import geo
from .operators import derived, merging
from .operators import elements as O
from .sources.areas import load_area
from .sources.xml import Elements, read_osm

#: A box, a line and a point for each customer; sizes in thousandths of a degree.
PLAN = """SELECT c_custkey AS c, ((c_custkey * 7919) % 34000) / 100.0e0 - 170 AS x, ((c_custkey * 104729) % 12000) / 100.0e0 - 60 AS y,
  (2 + 2 * (c_custkey % 5)) / 1000.0e0 AS w, (2 + 2 * (c_custkey % 3)) / 1000.0e0 AS h FROM customer"""
AREA_TAGS = """CASE c % 8 WHEN 0 THEN 'building' WHEN 1 THEN 'landuse' WHEN 2 THEN 'natural' WHEN 3 THEN 'waterway' WHEN 4 THEN 'aeroway' WHEN 5 THEN 'landuse' WHEN 6 THEN 'railway' ELSE 'boundary' END AS k,
  CASE c % 8 WHEN 0 THEN 'yes' WHEN 1 THEN 'park' WHEN 2 THEN 'water' WHEN 3 THEN 'riverbank' WHEN 4 THEN 'apron' WHEN 5 THEN 'reservoir' WHEN 6 THEN 'station' ELSE 'administrative' END AS v"""
LINE_TAGS = """CASE c % 5 WHEN 0 THEN 'waterway' WHEN 1 THEN 'waterway' WHEN 2 THEN 'aeroway' WHEN 3 THEN 'highway' ELSE 'railway' END AS k,
  CASE c % 5 WHEN 0 THEN 'river' WHEN 1 THEN 'stream' WHEN 2 THEN 'runway' WHEN 3 THEN 'motorway' ELSE 'tram' END AS v, CASE WHEN c % 2 = 0 THEN 'yes' END AS tunnel"""
NODE_TAGS = "CASE c % 3 WHEN 0 THEN 'school' WHEN 1 THEN 'police' ELSE 'nothing' END AS v"

_roots: list[tempfile.TemporaryDirectory] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder: below spark.checkpoint.dir, or a temporary one where Spark runs in one JVM."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        if not _roots:
            _roots.append(tempfile.TemporaryDirectory(prefix="mapforge-"))
            atexit.register(_roots[0].cleanup)
        root = f"file://{_roots[0].name}"
    path = f"{root.rstrip('/')}/mapforge-files/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def elements(spark: SparkSession, sf_dir: str) -> Elements:
    """Way 10c + 1 is customer c's box, way 10c + 2 its line, node 10c its point; relation c holds the box where c % 4 is 1."""
    plan = _view(spark, sf_dir, f"SELECT *, {AREA_TAGS} FROM ({PLAN}) p")
    n = F.col("c") * 10

    def at(i: int, x: Column, y: Column) -> Column:
        return F.struct((n + i).alias("osm_id"), x.alias("lon"), y.alias("lat"))

    x0, y0, x1, y1 = F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")
    coords = plan.select(F.inline(F.array(at(0, x0, y0), at(1, x1, y0), at(2, x1, y1), at(3, x0, y1))))
    tag = lambda k, v: F.map_from_entries(F.filter(F.array(*[F.struct(a.alias("key"), b.alias("value")) for a, b in zip(k, v, strict=True)]), lambda e: e["value"].isNotNull()))
    level = F.when(F.col("k") == "boundary", (F.col("c") % 9).cast("string"))
    boxes = plan.select((n + 1).alias("osm_id"), tag([F.col("k"), F.lit("admin_level")], [F.col("v"), level]).alias("tags"), F.array(n, n + 1, n + 2, n + 3, n).alias("refs"))
    lines = _view(spark, sf_dir, f"SELECT *, {LINE_TAGS} FROM ({PLAN}) p")
    lines = lines.select((n + 2).alias("osm_id"), tag([F.col("k"), F.lit("tunnel")], [F.col("v"), F.col("tunnel")]).alias("tags"), F.array(n, n + 1).alias("refs"))
    nodes = _view(spark, sf_dir, f"SELECT c, x, y, {NODE_TAGS} FROM ({PLAN}) p").select(n.alias("osm_id"), tag([F.lit("amenity")], [F.col("v")]).alias("tags"), F.col("x").alias("lon"), F.col("y").alias("lat"))
    member = F.struct((n + 1).alias("ref"), F.lit("way").alias("type"), F.lit("outer").alias("role"))
    relations = plan.where("c % 4 = 1").select(F.col("c").alias("osm_id"), tag([F.lit("type"), F.col("k"), F.lit("name")], [F.lit("multipolygon"), F.col("v"), F.lit("whole")]).alias("tags"), F.array(member).alias("members"))
    return Elements(coords, nodes, boxes.unionByName(lines), relations)


def _tables(spark: SparkSession, sf_dir: str, srid: int = 4326) -> dict[str, DataFrame]:
    return engine.base_tables(elements(spark, sf_dir), MAPPING, engine.Options(srid=srid))


def _areas(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tables(spark, sf_dir)[name].select("osm_id", "type", F.round(geo.st_area("geometry") * 1e6, 3).alias("area"))

    return run


def _lengths(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tables(spark, sf_dir)[name].select("osm_id", "type", F.round(geo.st_length("geometry") * 1e3, 3).alias("length"))

    return run


def import_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tables(spark, sf_dir)["admin"].select("osm_id", "type", "admin_level", F.round(geo.st_area("geometry") * 1e6, 3).alias("area"))


def import_amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _tables(spark, sf_dir)["amenities"].withColumn("b", geo.st_bounds("geometry"))
    return b.select("osm_id", "type", F.round("b.minx", 4).alias("lon"), F.round("b.maxy", 4).alias("lat"))


def _generalized(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A generalized table of the default mapping, repaired where it declares that."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = engine.derived_tables(_tables(spark, sf_dir, 3857), MAPPING)
        return tables[name].select("osm_id", "type", geo.st_isvalid("geometry").cast("int").alias("valid"))

    return run


def import_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging, writing, optimizing, deploying twice, recovering: the rows of each production table, by what is left of them."""
    staging = engine.Staging(spark, scratch(spark, "staging"))
    staging.save(elements(spark, sf_dir), MAPPING)
    p = catalog.Prefixes(*(f"q{uuid.uuid4().hex[:8]}_{x}" for x in ("new", "now", "old")))
    try:
        engine.write(spark, staging, MAPPING, engine.Options(srid=3857), p)
        catalog.optimize(spark, p)
        catalog.deploy(spark, MAPPING, p)
        engine.write(spark, staging, MAPPING, engine.Options(srid=3857, limit=None), p)
        catalog.deploy(spark, MAPPING, p)
        catalog.recover(spark, MAPPING, p)
        names = ("admin", "amenities", "landusages", "waterareas", "waterways", "roads")
        rows = [(n, spark.table(p.production + n).count()) for n in names]
        rows.append(("rejects", staging.rejects().count()))
    finally:
        for which in (p.new, p.production, p.backup):
            catalog.remove(spark, p, which)
    return spark.createDataFrame(rows, "name string, n long")


def _xml(spark: SparkSession, sf_dir: str, compression: str | None) -> DataFrame:
    """An XML file of the suppliers' nodes and ways, written by Spark, read as an extract."""
    path = scratch(spark, "osm") + ".osm"
    base = _view(spark, sf_dir, "SELECT CAST(s_suppkey AS BIGINT) AS s, s_name FROM supplier")
    node = F.format_string('<node id="%d" lon="%.2f" lat="%.2f"><tag k="name" v="%s &amp; Co"/></node>', "s", F.col("s") / 100.0, -F.col("s") / 50.0, "s_name")
    way = F.format_string('<way id="%d"><nd ref="%d"/><nd ref="%d"/><tag k="highway" v="road"/></way>', F.col("s") + 1000000, "s", F.col("s") + 1)
    # An extract is one file with one root, so its lines are written in order by one task.
    ends = spark.createDataFrame([(-1, "<osm>"), (1 << 62, "</osm>")], "s long, value string")
    lines = base.select("s", F.concat(node, way).alias("value")).unionByName(ends).repartition(1).sortWithinPartitions("s").select("value")
    (lines.write.option("compression", compression) if compression else lines.write).text(path)
    e = read_osm(spark, path)
    named = e.nodes.select("osm_id", F.try_element_at("tags", F.lit("name")).alias("name"), F.round("lon", 2).alias("lon"), F.round("lat", 2).alias("lat"))
    ways = e.ways.select(F.get("refs", F.lit(0)).alias("osm_id"), F.size("refs").cast("long").alias("n_refs"), F.try_element_at("tags", F.lit("highway")).alias("highway"))
    return named.join(ways, "osm_id")


def limit_area_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit area from a file of WKT, one polygon a nation: its measure and bounds."""
    path = scratch(spark, "area")
    text = F.format_string("POLYGON((%d 0,%d 0,%d 1,%d 1,%d 0))", *[F.col("n_nationkey") * 3 + d for d in (0, 2, 2, 0, 0)])
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(text.alias("value")).coalesce(1).write.text(path)
    from .geometry import planar

    area = load_area(spark, f"{path}/part-*")
    x0, _, x1, _ = planar.bounds(area)
    return spark.createDataFrame([(len(area[1]), planar.area(area), float(x0), float(x1))], "n long, area double, x0 double, x1 double")


def merge_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's node in two extracts: the later one's place and tags count."""
    first = _tagged(_view(spark, sf_dir, "SELECT c_custkey AS osm_id, c_custkey / 100.0e0 AS lon, 1.0e0 AS lat, c_name AS name FROM customer")).withColumn("file", F.lit(0))
    later = first.where("osm_id % 3 = 0").withColumn("file", F.lit(1)).withColumn("lat", F.lit(2.0))
    return merging.merge_points(first.unionByName(later), "file").select("osm_id", F.round("lon", 2).alias("lon"), "lat")


def rejected_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why relations have no polygon: every third lacks a way, every fifth a vertex; the rest is built."""
    from .operators import multipolygon

    e = elements(spark, sf_dir)
    built = multipolygon.assembled(e.relations, e.ways.where("osm_id % 3 <> 0"), e.coords.where("osm_id % 50 <> 10"))
    return built.select("osm_id", F.coalesce("reason", F.lit("built")).alias("reason"))


def line_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and lines as geometries, and back as text."""
    e = elements(spark, sf_dir)
    lines = O.resolve(e.ways.where("osm_id % 10 = 2"), e.coords).withColumn("geometry", geo.line("line"))
    b = lines.withColumn("b", geo.st_bounds("geometry"))
    points = e.coords.withColumn("geometry", geo.point("lon", "lat")).withColumn("b", geo.st_bounds("geometry"))
    shown = [F.round("b.minx", 4).alias("x0"), F.round("b.maxx", 4).alias("x1"), geo.st_kind("geometry").alias("kind")]
    return b.select("osm_id", *shown).unionByName(points.select("osm_id", *shown))


def simplified_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """derived.generalized with a where on a column, on the boxes of closed ways."""
    e = elements(spark, sf_dir)
    rings = O.resolve(e.ways.where("osm_id % 10 = 1"), e.coords).select("osm_id", F.round(O.ring_area(F.col("line")) * 1e6, 3).alias("area"), geo.ring("line").alias("geometry"))
    return derived.generalized(rings, 0.0001, "area > 20").select("osm_id", "area", geo.st_npoints("geometry").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "import_buildings": _areas("buildings"),
    "import_transport_areas": _areas("transport_areas"),
    "import_landusages": _areas("landusages"),
    "import_waterareas": _areas("waterareas"),
    "import_waterways": _lengths("waterways"),
    "import_aeroways": _lengths("aeroways"),
    "import_admin": import_admin,
    "import_amenities": import_amenities,
    "import_landusages_gen0": _generalized("landusages_gen0"),
    "import_waterareas_gen1": _generalized("waterareas_gen1"),
    "import_deploy": import_deploy,
    "read_xml": lambda s, d: _xml(s, d, None),
    "read_xml_bz2": lambda s, d: _xml(s, d, "bzip2"),
    "limit_area_wkt": limit_area_wkt,
    "merge_nodes": merge_nodes,
    "rejected_relations": rejected_relations,
    "line_geometry": line_geometry,
    "simplified_boxes": simplified_boxes,
}

_P = f"p AS (SELECT * FROM ({PLAN}) q)"
_A = f"{_P}, a AS (SELECT *, {AREA_TAGS} FROM p)"
_AREA = "round(w * h * 1e6, 3) AS area"
#: A relation takes the place of its box in tables that leave inserted ways out; admin has both.
_ID = "CASE WHEN c % 4 = 1 THEN c ELSE 10 * c + 1 END AS osm_id"
_MERC = "(radians(w) * 6378137.0e0 * 6378137.0e0 * (ln(tan(pi() / 4 + radians(y + h) / 2)) - ln(tan(pi() / 4 + radians(y) / 2))))"


def _area_sql(values: str) -> str:
    return f"WITH {_A} SELECT {_ID}, v AS type, {_AREA} FROM a WHERE v IN ({values})"


def _xml_sql() -> str:
    return "SELECT CAST(s_suppkey AS BIGINT) AS osm_id, s_name || ' & Co' AS name, round(s_suppkey / 100.0e0, 2) AS lon, round(-s_suppkey / 50.0e0, 2) AS lat, CAST(2 AS BIGINT) AS n_refs, 'road' AS highway FROM supplier"


def _count(name: str, where: str) -> str:
    return f"SELECT '{name}' AS name, count(*) AS n FROM a WHERE {where}"


ORACLES: dict[str, str] = {
    "import_buildings": _area_sql("'yes'"),
    "import_transport_areas": _area_sql("'apron', 'station'"),
    "import_landusages": _area_sql("'park'"),
    "import_waterareas": _area_sql("'water', 'riverbank', 'reservoir'"),
    "import_waterways": f"WITH {_P} SELECT 10 * c + 2 AS osm_id, CASE c % 5 WHEN 0 THEN 'river' ELSE 'stream' END AS type, round(w * 1e3, 3) AS length FROM p WHERE c % 5 IN (0, 1) AND c % 2 = 1",
    "import_aeroways": f"WITH {_P} SELECT 10 * c + 2 AS osm_id, 'runway' AS type, round(w * 1e3, 3) AS length FROM p WHERE c % 5 = 2",
    "import_admin": f"WITH {_A} SELECT 10 * c + 1 AS osm_id, v AS type, CAST(c % 9 AS SMALLINT) AS admin_level, {_AREA} FROM a WHERE k = 'boundary' AND c % 9 BETWEEN 1 AND 6",
    "import_amenities": f"WITH {_P}, a AS (SELECT *, {NODE_TAGS} FROM p) SELECT 10 * c AS osm_id, v AS type, round(x, 4) AS lon, round(y, 4) AS lat FROM a WHERE v <> 'nothing'",
    "import_landusages_gen0": f"WITH {_A} SELECT {_ID}, v AS type, CAST(1 AS INT) AS valid FROM a WHERE v = 'park' AND {_MERC} > 500000",
    "import_waterareas_gen1": f"WITH {_A} SELECT {_ID}, v AS type, CAST(1 AS INT) AS valid FROM a WHERE v IN ('water', 'riverbank', 'reservoir') AND {_MERC} > 50000",
    "import_deploy": f"WITH {_A} " + " UNION ALL ".join((
        _count("admin", "k = 'boundary' AND c % 9 BETWEEN 1 AND 6"), _count("amenities", "c % 3 < 2"), _count("landusages", "v = 'park'"), _count("waterareas", "v IN ('water', 'riverbank', 'reservoir')"),
        _count("waterways", "c % 5 IN (0, 1) AND c % 2 = 1"), _count("roads", "c % 5 IN (3, 4)"), _count("rejects", "false"),
    )),
    "read_xml": _xml_sql(),
    "read_xml_bz2": _xml_sql(),
    "limit_area_wkt": "SELECT count(*) AS n, CAST(2 * count(*) AS DOUBLE) AS area, CAST(min(n_nationkey) * 3 AS DOUBLE) AS x0, CAST(max(n_nationkey) * 3 + 2 AS DOUBLE) AS x1 FROM nation",
    "merge_nodes": "SELECT c_custkey AS osm_id, round(c_custkey / 100.0e0, 2) AS lon, CASE WHEN c_custkey % 3 = 0 THEN 2.0e0 ELSE 1.0e0 END AS lat FROM customer",
    "rejected_relations": f"WITH {_P} SELECT c AS osm_id, CASE WHEN (10 * c + 1) % 3 = 0 OR c % 5 = 1 THEN 'missing way or vertex' ELSE 'built' END AS reason FROM p WHERE c % 4 = 1",
    "line_geometry": f"""WITH {_P} SELECT 10 * c + 2 AS osm_id, round(x, 4) AS x0, round(x + w, 4) AS x1, 'LineString' AS kind FROM p
        UNION ALL SELECT 10 * c + i AS osm_id, round(CASE WHEN i IN (1, 2) THEN x + w ELSE x END, 4) AS x0, round(CASE WHEN i IN (1, 2) THEN x + w ELSE x END, 4) AS x1, 'Point' AS kind FROM p, range(0, 4) r(i)""",
    "simplified_boxes": f"WITH {_P} SELECT 10 * c + 1 AS osm_id, {_AREA}, CAST(5 AS BIGINT) AS n FROM p WHERE round(w * h * 1e6, 3) > 20",
}
