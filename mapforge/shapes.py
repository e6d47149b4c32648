"""Registered queries of the geometry operators: shapes whose measures are known in closed form, which the SQL states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bridge import _view, spread
from .functions import geo
from .geometry import planar
from .operators import clip, derived, merging, multipolygon

BOXES = """SELECT c_custkey AS osm_id, CAST((c_custkey * 7919) % 340 AS INT) - 170 AS x, CAST((c_custkey * 104729) % 160 AS INT) - 80 AS y,
  CAST(1 + c_custkey % 5 AS INT) AS w, CAST(1 + c_custkey % 3 AS INT) AS h FROM customer"""
BOX_TEXT = "concat('POLYGON((', x, ' ', y, ',', x + w, ' ', y, ',', x + w, ' ', y + h, ',', x, ' ', y + h, ',', x, ' ', y, '))')"
BOW_TEXT = "concat('POLYGON((', x, ' ', y, ',', x + w, ' ', y + h, ',', x + w, ' ', y, ',', x, ' ', y + h, ',', x, ' ', y, '))')"
SPIKE_TEXT = "concat('POLYGON((', x, ' ', y, ',', x, ' ', y + h, ',', x + w, ' ', y + h, ',', x + w, ' ', y, ',', x + w + 2, ' ', y, ',', x, ' ', y, '))')"
LINE_TEXT = "concat('LINESTRING(', x, ' ', y, ',', x + w, ' ', y, ')')"
BENT_TEXT = "concat('LINESTRING(', x, ' ', y, ',', x + 1, ' ', y + (osm_id % 10) / 10.0e0, ',', x + 2, ' ', y, ')')"
LIMIT = (-40.5, -20.5, 61.5, 45.5)


def _shapes(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    rows = spread(_view(spark, sf_dir, f"SELECT osm_id, {text} AS wkt FROM ({BOXES}) b"), "osm_id")
    return rows.select("osm_id", "wkt", geo.from_text("wkt").alias("geometry"))


def _limited(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    area = ("Polygon", planar.box(*LIMIT))
    return clip.limited(_shapes(spark, sf_dir, text).drop("wkt"), clip.limit_parts(spark, area), ["osm_id"])


def clip_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limited(spark, sf_dir, BOX_TEXT).select("osm_id", F.round(geo.st_area("geometry"), 6).alias("area"))


def clip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _limited(spark, sf_dir, LINE_TEXT).select("osm_id", F.round(geo.st_length("geometry"), 6).alias("length"))


def wkt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shapes(spark, sf_dir, BOX_TEXT).select("osm_id", geo.as_text("geometry").alias("wkt"))


def polygon_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"CASE WHEN osm_id % 3 = 0 THEN {BOW_TEXT} WHEN osm_id % 3 = 1 THEN {SPIKE_TEXT} ELSE {BOX_TEXT} END"
    return _shapes(spark, sf_dir, text).select("osm_id", geo.st_isvalid("geometry").cast("int").alias("valid"))


def repair_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"CASE WHEN osm_id % 3 = 1 THEN {SPIKE_TEXT} ELSE {BOX_TEXT} END"
    return derived.repaired(_shapes(spark, sf_dir, text)).select("osm_id", F.round(geo.st_area("geometry"), 6).alias("area"), geo.st_isvalid("geometry").cast("int").alias("valid"))


def generalized_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = derived.generalized(_shapes(spark, sf_dir, BENT_TEXT), 0.45, "ST_NPoints(geometry) > 2 AND osm_id % 7 <> 0")
    return got.select("osm_id", geo.st_npoints("geometry").alias("n"))


def mercator_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = geo.st_transform("geometry", F.lit(4326), F.lit(3857))
    return _shapes(spark, sf_dir, LINE_TEXT).select("osm_id", F.round(geo.st_length(moved), 3).alias("metres"))


def polygon_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _shapes(spark, sf_dir, BOX_TEXT).withColumn("b", geo.st_bounds("geometry"))
    return b.select("osm_id", "b.minx", "b.miny", "b.maxx", "b.maxy")


def _suppliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A relation for each supplier: a square of two open ways, in every second a hole, in every third of these an island."""
    base = _view(spark, sf_dir, "SELECT CAST(s_suppkey AS BIGINT) AS s FROM supplier")
    n = F.col("s") * 100
    side = 4 + F.col("s") % 5

    def corners(first: int, low, size) -> list:
        at = [(low, low), (low + size, low), (low + size, low + size), (low, low + size)]
        return [F.struct((n + first + i).alias("osm_id"), x.cast("double").alias("lon"), y.cast("double").alias("lat")) for i, (x, y) in enumerate(at)]

    points = F.array(*corners(0, F.lit(0.0), side), *corners(4, F.lit(1.0), side - 2), *corners(8, F.lit(1.5), F.lit(0.5)))
    coords = base.select(F.inline(points)).where("NOT (osm_id % 1100 = 2)")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = F.map_from_arrays(F.array(F.lit("landuse")), F.array(F.lit("park")))
    way = lambda i, t, *refs: F.struct((F.col("s") * 10 + i).alias("osm_id"), t.alias("tags"), F.array(*[n + r for r in refs]).alias("refs"))
    ways = base.select(F.inline(F.array(way(1, tags, 0, 1, 2), way(2, none, 0, 3, 2), way(3, none, 4, 5, 6, 7, 4), way(4, none, 8, 9, 10, 11, 8))))
    member = lambda i: F.struct((F.col("s") * 10 + i).alias("ref"), F.lit("way").alias("type"), F.lit("").alias("role"))
    some = F.concat(F.array(member(1), member(2)), F.when(F.col("s") % 2 == 0, F.array(member(3))).otherwise(F.array()), F.when(F.col("s") % 6 == 0, F.array(member(4))).otherwise(F.array()))
    own = F.map_from_arrays(F.array(F.lit("type")), F.array(F.lit("multipolygon")))
    return base.select(F.col("s").alias("osm_id"), own.alias("tags"), some.alias("members")), ways, coords


def _relations(method: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = multipolygon.assembled(*_suppliers(spark, sf_dir), method=method).where("geometry IS NOT NULL")
        return built.select("osm_id", F.round("area", 6).alias("area"), F.try_element_at("tags", F.lit("landuse")).alias("landuse"), F.size("ways").alias("n_ways"), geo.st_isvalid("geometry").cast("int").alias("valid"))

    return run


def merge_way_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a way that two extracts cut differently; some pieces do not meet."""
    k = F.col("o_orderkey")
    copies = _view(spark, sf_dir, "SELECT o_orderkey, o_orderstatus FROM orders")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    first = copies.select(k.alias("osm_id"), none.alias("tags"), F.sequence(F.lit(1).cast("long"), 3 + k % 4).alias("refs"), F.lit(0).alias("file"))
    later = copies.select(k.alias("osm_id"), none.alias("tags"), F.sequence(2 + k % 7, 9 + k % 7).alias("refs"), F.lit(1).alias("file"))
    got = merging.merge_ways(first.unionByName(later), "file")
    return got.select("osm_id", F.size("refs").cast("long").alias("n"), F.element_at("refs", -1).alias("last_ref"), F.col("partial").cast("int").alias("in_pieces"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clip_polygons": clip_polygons,
    "clip_lines": clip_lines,
    "wkt_round_trip": wkt_round_trip,
    "polygon_validity": polygon_validity,
    "repair_polygons": repair_polygons,
    "generalized_lines": generalized_lines,
    "mercator_lines": mercator_lines,
    "polygon_bounds": polygon_bounds,
    "multipolygon_contains": _relations("contains"),
    "multipolygon_union": _relations("union"),
    "merge_way_sequences": merge_way_sequences,
}

_X0, _Y0, _X1, _Y1 = LIMIT
_WIDE = f"(least(x + w, {_X1}) - greatest(x, {_X0}))"
_HIGH = f"(least(y + h, {_Y1}) - greatest(y, {_Y0}))"
_POLYGONS = """SELECT CAST(s AS BIGINT) AS osm_id, CAST(a * a - CASE WHEN s % 2 = 0 THEN (a - 2) * (a - 2) ELSE 0 END + CASE WHEN s % 6 = 0 THEN 0.25 ELSE 0 END AS DOUBLE) AS area,
  'park' AS landuse, CAST(2 + CASE WHEN s % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN s % 6 = 0 THEN 1 ELSE 0 END AS INT) AS n_ways, CAST(1 AS INT) AS valid
  FROM (SELECT s_suppkey AS s, 4 + s_suppkey % 5 AS a FROM supplier) q WHERE s % 11 <> 0"""
ORACLES: dict[str, str] = {
    "clip_polygons": f"SELECT osm_id, round(CAST({_WIDE} * {_HIGH} AS DOUBLE), 6) AS area FROM ({BOXES}) b WHERE {_WIDE} > 0 AND {_HIGH} > 0",
    "clip_lines": f"SELECT osm_id, round(CAST({_WIDE} AS DOUBLE), 6) AS length FROM ({BOXES}) b WHERE {_WIDE} > 0 AND y BETWEEN {_Y0} AND {_Y1}",
    "wkt_round_trip": f"SELECT osm_id, {BOX_TEXT} AS wkt FROM ({BOXES}) b",
    "polygon_validity": f"SELECT osm_id, CAST(CASE WHEN osm_id % 3 = 2 THEN 1 ELSE 0 END AS INT) AS valid FROM ({BOXES}) b",
    "repair_polygons": f"SELECT osm_id, CAST(w * h AS DOUBLE) AS area, CAST(1 AS INT) AS valid FROM ({BOXES}) b",
    "generalized_lines": f"SELECT osm_id, CAST(CASE WHEN osm_id % 10 <= 4 THEN 2 ELSE 3 END AS BIGINT) AS n FROM ({BOXES}) b WHERE osm_id % 7 <> 0",
    "mercator_lines": f"SELECT osm_id, round(radians(w) * 6378137.0, 3) AS metres FROM ({BOXES}) b",
    "polygon_bounds": f"SELECT osm_id, CAST(x AS DOUBLE) AS minx, CAST(y AS DOUBLE) AS miny, CAST(x + w AS DOUBLE) AS maxx, CAST(y + h AS DOUBLE) AS maxy FROM ({BOXES}) b",
    "multipolygon_contains": _POLYGONS,
    "multipolygon_union": _POLYGONS,
    "merge_way_sequences": """SELECT o_orderkey AS osm_id, CASE WHEN b <= a THEN e ELSE a END AS n, CASE WHEN b <= a THEN e ELSE a END AS last_ref, CAST(CASE WHEN b <= a THEN 0 ELSE 1 END AS INT) AS in_pieces
  FROM (SELECT o_orderkey, 3 + o_orderkey % 4 AS a, 2 + o_orderkey % 7 AS b, 9 + o_orderkey % 7 AS e FROM orders) q""",
}
