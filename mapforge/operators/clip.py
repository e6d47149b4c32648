"""Clipping features to a limit area: grid cells pair features with parts of the area, then parts cut them.

The area is cut along a grid once, so a feature meets only the parts near it, however large the area
is. Features and parts have cells of their own size: a small part gathers only what is near it, and a large
feature has a few large cells. The joins on cells are equi-joins, and Catalyst broadcasts the parts where
their size allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..geometry import codec, planar

#: Degrees of the join's cells, by level.
CELLS = (0.1, 1.0, 10.0, 100.0, 1000.0)


def checked_wgs84(area: codec.Geometry) -> codec.Geometry:
    """The area, unless some of it lies beyond the degrees that there are."""
    found = planar.bounds(area)
    if found is None or not planar.polygons(area):
        raise ValueError("the limit has no polygon")
    if found[0] < -180 or found[1] < -90 or found[2] > 180 or found[3] > 90:
        raise ValueError("the limit is not in degrees of longitude and latitude")
    return area


def limit_parts(spark: SparkSession, area: codec.Geometry) -> DataFrame:
    """(part, geometry, minx, miny, maxx, maxy) of the area, cut at a grid."""
    items = planar.polygons(checked_wgs84(area))
    items = items if planar.is_valid(area) else planar.repaired(items)
    rows = []
    for polygon in items:
        for _, _, part in planar.tiled(polygon):
            rows.append((len(rows), codec.to_wkb(("Polygon", part)), *map(float, planar.bounds(("Polygon", part)))))
    return spark.createDataFrame(rows, "part int, geometry binary, minx double, miny double, maxx double, maxy double")


def _with_cells(df: DataFrame, b: str, own: bool | None = None) -> DataFrame:
    """df with a row for each cell (_level, _cx, _cy) that its bounds meet, a few a level.

    Own cells are those of the first level whose cells are as large as the bounds; the others are all larger ones.
    With own None it is both.
    """
    x0, x1, y0, y1 = (F.col(f"{b}{c}") for c in ("minx", "maxx", "miny", "maxy"))
    extent = F.greatest(x1 - x0, y1 - y0)
    first = F.lit(len(CELLS) - 1)
    for k in reversed(range(len(CELLS) - 1)):
        first = F.when(extent <= CELLS[k], k).otherwise(first)
    levels = F.sequence(F.lit(0), F.lit(len(CELLS) - 1))
    wanted = {None: lambda k: k >= first, True: lambda k: k == first, False: lambda k: k > first}[own]
    width = F.element_at(F.array(*map(F.lit, CELLS)), F.col("_level") + 1)
    span = lambda low, high: F.sequence(F.floor(low / width), F.floor(high / width))
    return df.withColumn("_level", F.explode(F.filter(levels, wanted))).withColumn("_cx", F.explode(span(x0, x1))).withColumn("_cy", F.explode(span(y0, y1)))


def near_parts(bounds: DataFrame, parts: DataFrame, key: list[str]) -> DataFrame:
    """(key, part) of the features (key, _b) and parts whose bounds meet.

    The two share a cell at the level of the larger one, so that is where they are joined: once for parts no smaller
    than the feature, once for smaller ones.
    """
    places = parts.select("part", "minx", "miny", "maxx", "maxy")
    on = ["_level", "_cx", "_cy"]
    pairs = _with_cells(bounds, "_b.").join(_with_cells(places, "", own=True), on)
    pairs = pairs.unionByName(_with_cells(bounds, "_b.", own=True).join(_with_cells(places, "", own=False), on))
    meets = (F.col("_b.minx") <= F.col("maxx")) & (F.col("_b.maxx") >= F.col("minx")) & (F.col("_b.miny") <= F.col("maxy")) & (F.col("_b.maxy") >= F.col("miny"))
    return pairs.where(meets).select(*key, "part").distinct()


def _cut(data: bytes, near: list[bytes], kind: str) -> list[bytes]:
    g = codec.from_wkb(bytes(data))
    pieces = []
    for part in near:
        items = planar.polygons(codec.from_wkb(bytes(part)))
        pieces += planar.clipped(g, items)
    # What lies whole within the area comes back byte for byte.
    flat = [p for x in pieces for p in codec.parts(x)]
    if not flat:
        return []
    if flat[0][0] == "Point":
        return [codec.to_wkb(flat[0])]
    if flat[0][0] == "LineString":
        lines = list(dict.fromkeys(tuple(c) for _, c in flat))
        if abs(sum(map(planar.length, lines)) - planar.length(g[1])) <= 1e-12 * planar.length(g[1]):
            return [bytes(data)]
        return [codec.to_wkb(("LineString", c)) for c in planar.joined_lines([list(c) for c in lines]) if planar.length(c) > planar.SHORT]
    merged = codec.gathered("Polygon", planar.repaired([c for _, c in flat]))
    if abs(planar.area(merged) - planar.area(g)) <= 1e-12 * planar.area(g):
        return [bytes(data)]
    return [codec.to_wkb(p) for p in planar.of_type(merged, kind)]


def limited(features: DataFrame, parts: DataFrame, key: list[str], geometry: str = "geometry") -> DataFrame:
    """features cut to the parts: a row for each piece of a line, one for a polygon; rows outside go.

    ``key`` names columns that tell rows apart. Only key and geometry pass through the cut; the other
    columns are joined to the result by key. A null geometry is outside.
    """
    narrow = features.select(*key, geometry).where(F.col(geometry).isNotNull()).withColumn("_b", geo.st_bounds(geometry))
    narrow = narrow.where("_b.minx is not null")
    near = near_parts(narrow.select(*key, "_b"), parts, key)
    shapes = near.join(parts.select("part", F.col("geometry").alias("_limit")), "part").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("part", "_limit"))).alias("_limits"))
    whole = narrow.select(*key, F.col(geometry).alias("_whole")).join(shapes, key)
    names = [f.name for f in whole.schema if f.name in key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                for i, piece in enumerate(_cut(r["_whole"], [x["_limit"] for x in r["_limits"]], "Polygon")):
                    rows.append([r[c] for c in names] + [i, piece])
            yield pd.DataFrame(rows, columns=[*names, "_piece", "_cut"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema if f.name in key) + ", _piece int, _cut binary"
    pieces = whole.mapInPandas(run, schema)
    rest = [c for c in features.columns if c != geometry]
    joined = features.select(*rest).join(pieces, key)
    return joined.select(*[F.col("_cut").alias(geometry) if c == geometry else F.col(c) for c in features.columns])
