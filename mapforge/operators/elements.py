"""From elements to features: resolving references, routing, geometry of ways, merging of extracts.

Elements: coords (osm_id, lon, lat), nodes (osm_id, tags, lon, lat), ways (osm_id, tags, refs) and
relations (osm_id, tags, members array<struct<ref, type, role>>).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import Field, Row
from ..mapping import MappingSet, TableSpec, routes

EARTH = 6378137.0


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Mercator metres."""
    return F.radians(lon) * EARTH, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH


def resolve(ways: DataFrame, coords: DataFrame) -> DataFrame:
    """ways with ``line``: their vertices array<struct<lon, lat>> in order of refs; ways that lack any vertex go.

    Only (osm_id, position, ref) is exploded and shuffled; coords are pruned to the refs by the join.
    """
    refs = ways.select("osm_id", F.size("refs").alias("n"), F.posexplode("refs").alias("at", "ref"))
    points = coords.select(F.col("osm_id").alias("ref"), "lon", "lat")
    lines = (
        refs.join(points, "ref").groupBy("osm_id", "n").agg(F.sort_array(F.collect_list(F.struct("at", "lon", "lat"))).alias("p"))
        .where(F.size("p") == F.col("n")).select("osm_id", F.transform("p", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("line"))
    )
    return ways.join(lines, "osm_id")


def closed(line: Column) -> Column:
    """Whether a line is a ring: four vertices or more, the last on the first."""
    return (F.size(line) >= 4) & (F.get(line, F.lit(0)) == F.element_at(line, -1))


def valid_line(line: Column) -> Column:
    """Two vertices or more, and not just two equal ones."""
    return (F.size(line) >= 2) & ~((F.size(line) == 2) & (F.get(line, F.lit(0)) == F.get(line, F.lit(1))))


def ring_area(line: Column) -> Column:
    """The planar area of a ring, by the shoelace formula."""
    n = F.size(line)
    parts = F.zip_with(F.slice(line, 1, n - 1), F.slice(line, 2, n - 1), lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return F.when(n >= 2, F.abs(F.aggregate(parts, F.lit(0.0), lambda t, x: t + x)) / 2).otherwise(F.lit(0.0))


def mid_latitude(line: Column) -> Column:
    lats = F.transform(line, lambda p: p["lat"])
    return F.array_min(lats) + F.abs(F.array_max(lats) - F.array_min(lats)) / 2


def split_line(line: Column, most: int) -> Column:
    """A long line as several of some ``most`` vertices that share their ends: an array of lines."""
    n = F.size(line)
    step = F.floor(n / F.ceil(n / F.lit(most))).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), n - 1, step), lambda i: F.slice(line, i, step + 1))
    return F.when(n > most, pieces).otherwise(F.array(line))


def routed(elements: DataFrame, m: MappingSet, *kinds: str) -> DataFrame:
    """elements, once per table that they lead to, with table, key and value."""
    rules = m.rules(*kinds)
    return elements.select("*", F.inline(routes(F.col("tags"), rules)))


def features(elements: DataFrame, spec: TableSpec, default_name: Field, area: Column | None = None, mid_lat: Column | None = None, keep: tuple[str, ...] = ("osm_id",)) -> DataFrame:
    """The rows of one table from routed elements: dropped ones out, columns derived."""
    row = Row(F.col("tags"), F.col("key"), F.col("value"), area, mid_lat)
    rows = elements.where(F.col("table") == spec.name)
    for f in spec.field_filter:
        rows = rows.where(f.expr(row) == 0)
    columns = spec.columns(default_name)
    for f in columns:
        if (gone := f.drops(row)) is not None:
            rows = rows.where(~gone)
    return rows.select(*keep, *[f.expr(row).cast(f.sql_type).alias(f.name) for f in columns])


def not_inserted(ways: DataFrame, inserted: DataFrame) -> DataFrame:
    """Ways but those that made a relation's polygon (osm_id), for polygon tables."""
    return ways.join(inserted.select("osm_id").distinct(), "osm_id", "left_anti")


def inserted_ways(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """osm_id of member ways that share a route (table, key, value) with their relation; both have ``routes``."""
    members = relations.select(F.col("routes").alias("of"), F.explode("members").alias("m")).where("m.type = 'way'").select("of", F.col("m.ref").alias("osm_id"))
    return members.join(ways.select("osm_id", "routes"), "osm_id").where(F.arrays_overlap("of", "routes")).select("osm_id").distinct()


def merge_tags(copies: DataFrame, order: str) -> DataFrame:
    """(osm_id, tags) of copies from several extracts: the later one's value of a key counts."""
    flat = copies.select("osm_id", order, F.explode("tags").alias("k", "v"))
    last = flat.groupBy("osm_id", "k").agg(F.max_by("v", order).alias("v"))
    return last.groupBy("osm_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("tags"))


def merge_members(members: Column) -> Column:
    """Members of several copies one after another: the first of each ref, whatever its type and role."""
    placed = F.array_sort(F.transform(members, lambda m, i: F.struct(m["ref"].alias("ref"), i.alias("at"), m.alias("m"))))
    # In order of refs, the first of a ref is the one whose ref differs from that before it.
    first = F.transform(F.array(placed), lambda s: F.filter(s, lambda x, i: (i == 0) | ~F.get(s, i - 1)["ref"].eqNullSafe(x["ref"])))[0]
    return F.transform(F.array_sort(F.transform(first, lambda x: F.struct(x["at"].alias("at"), x["m"].alias("m")))), lambda x: x["m"])


def union_rows(routed_elements: DataFrame, specs: list[TableSpec], fields: dict[str, object], default_name: Field) -> DataFrame:
    """The rows of union_view over the tables of specs, from routed elements in one pass: a column is what the row's table says."""
    row = Row(F.col("tags"), F.col("key"), F.col("value"))
    wanted = {"name": "", **fields, **({"type": None} if "type" not in fields else {})}
    columns = {s.name: {f.name: f for f in s.columns(default_name)} for s in specs}
    rows = routed_elements.where(F.col("table").isin([s.name for s in specs]))
    for s in specs:
        for f in s.field_filter:
            rows = rows.where((F.col("table") != s.name) | (f.expr(row) == 0))
        for f in columns[s.name].values():
            if (gone := f.drops(row)) is not None:
                rows = rows.where((F.col("table") != s.name) | ~gone)

    def value(c: str, default: object) -> Column:
        kind = next((columns[s.name][c].sql_type for s in specs if c in columns[s.name]), "string")
        out = F.lit(default).cast(kind)
        for s in specs:
            if c in columns[s.name]:
                out = F.when(F.col("table") == s.name, columns[s.name][c].expr(row).cast(kind)).otherwise(out)
        return out.alias(c)

    label = F.create_map(*[F.lit(x) for s in specs for x in (s.name, s.classname or s.name)])[F.col("table")]
    return rows.select("osm_id", *[value(c, d) for c, d in wanted.items()], label.alias("class"))


def union_view(tables: dict[str, DataFrame], fields: dict[str, object], with_type: bool = True, classes: dict[str, str] | None = None) -> DataFrame:
    """All rows of the tables with the same columns: a missing one has the view's default; ``class`` names the table."""
    wanted = {"name": "", **fields, **({"type": None} if with_type and "type" not in fields else {})}
    types: dict[str, str] = {}
    for df in tables.values():
        types |= {n: t for n, t in df.dtypes if n not in types}
    out = None
    for name, df in tables.items():
        there = set(df.columns)
        extra = [F.col("geometry")] if "geometry" in there else []
        cols = [(F.col(c) if c in there else F.lit(d)).cast(types.get(c, "string")).alias(c) for c, d in wanted.items()]
        part = df.select("osm_id", *extra, *cols, F.lit((classes or {}).get(name, name)).alias("class"))
        out = part if out is None else out.unionByName(part)
    return out


def documents(rows: DataFrame) -> DataFrame:
    """(osm_id, geom_type, tables, fields) from (osm_id, geom_type, table, fields map): one object per element and geometry type."""
    flat = rows.select("osm_id", "geom_type", "table", F.explode("fields").alias("k", "v"))
    last = flat.groupBy("osm_id", "geom_type", "k").agg(F.max_by("v", "table").alias("v"))
    merged = last.groupBy("osm_id", "geom_type").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("fields"))
    names = rows.groupBy("osm_id", "geom_type").agg(F.sort_array(F.collect_set("table")).alias("tables"))
    return names.join(merged, ["osm_id", "geom_type"])


def estimate_records(sizes: dict[str, int]) -> dict[str, int]:
    """Expected records of files by size: a hint for the number of partitions."""
    factor = lambda name: 11 if name.endswith(".bz2") else 15 if name.endswith(".pbf") else 1
    coords = sum(size * factor(name) for name, size in sizes.items()) // 200
    return {"coords": coords, "nodes": coords // 50, "ways": coords // 7, "relations": coords // 1000}


def tile_boxes(bounds: tuple[float, float, float, float], width: float) -> list[tuple[float, float, float, float]]:
    """The boxes of a grid that cover bounds, column by column."""
    x0, y0, x1, y1 = (math.floor(bounds[0] / width), math.floor(bounds[1] / width), math.ceil(bounds[2] / width), math.ceil(bounds[3] / width))
    return [(x * width, y * width, (x + 1) * width, (y + 1) * width) for x in range(x0, x1) for y in range(y0, y1)]
