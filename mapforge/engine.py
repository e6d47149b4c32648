"""From files to feature tables: staging, routing, geometry, limit, derived tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Prefixes, clustered, create, create_views, together
from .functions import geo
from .geometry import codec
from .mapping import MappingSet, node_tags, relation_tags, routes, way_tags
from .operators import clip, derived, merging, multipolygon
from .operators import elements as O
from .sources.pbf import read_pbf, read_pbf_files
from .sources.xml import Elements, read_osm

KINDS = ("coords", "nodes", "ways", "relations")


@dataclass(frozen=True)
class Options:
    srid: int = 4326
    max_length: int = 0  # vertices of a line before it is split; 0: never
    relation_builder: str = "contains"
    partial_relations: bool = False
    max_rings: int = 0  # relations with more rings are left out; 0: none
    limit: codec.Geometry | None = None
    slow: float = 60.0  # relations that take as many seconds or more are reported


#: Keeps a step's result under a name, so that what is made of it doesn't compute it again; the third argument names a column to divide it by.
Keep = Callable[[str, DataFrame, str | None], DataFrame]


def _lazy(name: str, df: DataFrame, by: str | None = None) -> DataFrame:
    return df


def read(spark: SparkSession, paths: list[str]) -> list[Elements]:
    """The elements of each file, by its name: .pbf, else XML."""

    def one(path: str) -> Elements:
        if path.endswith(".pbf"):
            return (read_pbf_files if "://" in path and not path.startswith("file://") else read_pbf)(spark, path)
        return read_osm(spark, path)

    return [one(p) for p in paths]


def merged(files: list[Elements]) -> Elements:
    """Several extracts as one."""
    if len(files) == 1:
        return files[0]
    files = [e if "partial" in e.ways.columns else replace(e, ways=e.ways.withColumn("partial", F.lit(False))) for e in files]
    copies = {k: reduce(DataFrame.unionByName, [getattr(e, k).withColumn("_file", F.lit(i)) for i, e in enumerate(files)]) for k in KINDS}
    ways = merging.merge_ways(copies["ways"], "_file")
    return Elements(merging.merge_points(copies["coords"], "_file"), merging.merge_points(copies["nodes"], "_file"), ways, merging.merge_relations(copies["relations"], "_file"))


class Staging:
    """Filtered elements as Parquet below a folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    def _files(self, root: str):
        """(file system, path) by Hadoop."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, root: str) -> bool:
        files, path = self._files(root)
        return files.exists(path)

    def exists(self) -> bool:
        """Whether there are elements; those of a merge that broke off between its renames are put back first."""
        if not self._there(self.root) and self._there(f"{self.root}__previous"):
            files, old = self._files(f"{self.root}__previous")
            files.rename(old, self._files(self.root)[1])
        return self._there(self.path("coords"))

    def keeper(self) -> tuple[Keep, Callable[[], None]]:
        """(Keep that writes below the folder, what deletes all that it wrote)."""
        folder = f"{self.root}/import-{uuid.uuid4().hex}"

        def keep(name: str, df: DataFrame, by: str | None = None) -> DataFrame:
            writer = df.write.partitionBy(by) if by else df.write
            writer.parquet(f"{folder}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        def done() -> None:
            files, path = self._files(folder)
            files.delete(path, True)

        return keep, done

    def rejects(self) -> DataFrame:
        """(kind, osm_id, reason) of what the last import had to leave out."""
        return self.spark.read.parquet(self.path("rejects"))

    def slow_relations(self) -> DataFrame:
        """(osm_id, seconds) of relations that took long to build in the last import."""
        return self.spark.read.parquet(self.path("slow"))

    def load(self) -> Elements:
        return Elements(*[self.spark.read.parquet(self.path(k)) for k in KINDS])

    def save(self, e: Elements, m: MappingSet, mode: str = "error") -> None:
        """Keep what tables can need: tags that are mapped, and all ways, as relations may be made of untagged ones.

        ``mode``: ``error`` if there is something already, ``overwrite`` it, or ``merge`` with it.
        """
        if mode not in ("error", "overwrite", "merge"):
            raise ValueError(f"no such mode: {mode}")
        there = self.exists()
        if there and mode == "error":
            raise FileExistsError(f"{self.root} holds elements already")
        e = replace(
            e,
            nodes=e.nodes.withColumn("tags", node_tags(F.col("tags"), m)).where(F.size("tags") > 0),
            ways=e.ways.withColumn("tags", way_tags(F.col("tags"), m)),
            relations=e.relations.withColumn("tags", relation_tags(F.col("tags"), m)).where(F.size("tags") > 0),
        )
        target = Staging(self.spark, f"{self.root}__merging") if there and mode == "merge" else self
        if target is not self:
            e = merged([self.load(), e])
        if "partial" not in e.ways.columns:
            e = replace(e, ways=e.ways.withColumn("partial", F.lit(False)))
        together(self.spark, [lambda kind=kind: getattr(e, kind).write.mode("overwrite").parquet(target.path(kind)) for kind in KINDS])
        if target is not self:
            # At each moment one of the two folders is whole: see exists().
            files, root = self._files(self.root)
            previous = self._files(f"{self.root}__previous")[1]
            files.delete(previous, True)
            files.rename(root, previous)
            files.rename(self._files(target.root)[1], root)
            files.delete(previous, True)


def _shaped(df: DataFrame, key: list[str], o: Options) -> DataFrame:
    """Geometries cut to the limit; lines and polygons may fall apart into rows or parts."""
    df = df.where(F.col("geometry").isNotNull())
    return clip.limited(df, clip.limit_parts(df.sparkSession, o.limit), key) if o.limit else df


def base_tables(e: Elements, m: MappingSet, o: Options = Options(), keep: Keep = _lazy) -> dict[str, DataFrame]:
    """The declared tables of filtered elements: osm_id, geometry and the columns.

    Vertices are resolved once, for tagged ways and members alike, relations are built once, and each kind of element
    is routed once. With a keep that writes, all tables are made from these results.
    """
    points = _shaped(e.nodes.where(F.size("tags") > 0).withColumn("geometry", geo.point("lon", "lat")), ["osm_id"], o)
    points = keep("points", O.routed(points.select("osm_id", "tags", "geometry"), m, "point"), "table")

    relations = e.relations.where(F.size("tags") > 0)
    ways = e.ways if "partial" in e.ways.columns else e.ways.withColumn("partial", F.lit(False))
    members = multipolygon.member_ways(relations, ways.where((F.size("tags") == 0) & ~F.col("partial")))
    wanted = ways.where(F.size("tags") > 0).unionByName(members).select("osm_id", "tags", "refs", "partial")
    resolved = keep("lines", O.resolve(wanted, e.coords), None)
    tagged = e.ways.where(F.size("tags") > 0).select("osm_id", "tags", "refs")
    lined = resolved.where(F.size("tags") > 0).select("osm_id", "tags", "line")

    pieces = lined.where(O.valid_line(F.col("line")) & (F.size(routes(F.col("tags"), m.rules("line"))) > 0))
    pieces = pieces.select("osm_id", "tags", F.posexplode(O.split_line(F.col("line"), o.max_length) if o.max_length else F.array("line")).alias("piece", "line"))
    lines = _shaped(pieces.select("osm_id", "tags", "piece", geo.line("line").alias("geometry")), ["osm_id", "piece"], o)
    lines = keep("routed-lines", O.routed(lines, m, "line"), "table")

    built = keep("relations", multipolygon.assembled_from(relations, resolved.where(~F.col("partial")), o.relation_builder, o.partial_relations, o.max_rings), None)
    if keep is not _lazy:
        _report(built, tagged, lined, o, keep)
    areas = _shaped(built.where(F.col("geometry").isNotNull()).select("osm_id", "tags", "ways", "geometry", "area", "mid_lat"), ["osm_id"], o)
    rings = lined.where(O.closed(F.col("line"))).where(F.size(routes(F.col("tags"), m.rules("polygon"))) > 0)
    rings = rings.select("osm_id", "tags", geo.ring("line").alias("geometry"), O.ring_area(F.col("line")).alias("area"), O.mid_latitude(F.col("line")).alias("mid_lat"))
    rings = _shaped(rings, ["osm_id"], o)
    if o.limit:
        # The area is that of what the limit left.
        areas, rings = (df.withColumn("area", geo.st_area("geometry")) for df in (areas, rings))
        areas = keep("areas", areas, None)

    made = keep("routed-relations", O.routed(areas.drop("ways"), m, "polygon"), "table")
    rows = {t.name: O.features(made, t, m.default_name, F.col("area"), F.col("mid_lat"), keep=("osm_id", "geometry")) for t in m.of("polygon")}
    skipping = [t.name for t in m.of("polygon") if t.skip_inserted]
    found = areas.withColumn("routes", routes(F.col("tags"), m.rules("polygon"))).select("osm_id", "ways", "routes")
    found = found.where(F.exists("routes", lambda r: r["table"].isin(skipping)))
    if rows:
        entered = reduce(DataFrame.unionByName, [df.select("osm_id") for df in rows.values()]).distinct()
        found = found.join(entered, "osm_id", "left_semi")
    member = F.transform("ways", lambda w: F.struct(w.alias("ref"), F.lit("way").alias("type"), F.lit("").alias("role")))
    gone = O.inserted_ways(found.select("osm_id", member.alias("members"), "routes"), tagged.withColumn("routes", routes(F.col("tags"), m.rules("polygon"))))
    alone = keep("routed-rings", O.routed(O.not_inserted(rings, gone), m, "polygon"), "table")

    out: dict[str, DataFrame] = {}
    for t in m.tables:
        if t.kind == "polygon":
            own = O.features(alone, t, m.default_name, F.col("area"), F.col("mid_lat"), keep=("osm_id", "geometry"))
            out[t.name] = rows[t.name].unionByName(own)
        else:
            out[t.name] = O.features(points if t.kind == "point" else lines, t, m.default_name, keep=("osm_id", "geometry"))
        if o.srid != 4326:
            out[t.name] = out[t.name].withColumn("geometry", geo.st_transform("geometry", F.lit(4326), F.lit(o.srid)))
    return out


def _report(built: DataFrame, tagged: DataFrame, lined: DataFrame, o: Options, keep: Keep) -> None:
    """Keep what could not be made, and why, and the relations that took long."""
    failed = built.where(F.col("geometry").isNull()).select(F.lit("relation").alias("kind"), "osm_id", "reason")
    lost = tagged.join(lined.select("osm_id"), "osm_id", "left_anti").select(F.lit("way").alias("kind"), "osm_id", F.lit("missing vertex").alias("reason"))
    flat = lined.where(~O.valid_line(F.col("line"))).select(F.lit("way").alias("kind"), "osm_id", F.lit("no line").alias("reason"))
    keep("rejects", failed.unionByName(lost).unionByName(flat), None)
    keep("slow", built.where(F.col("seconds") >= o.slow).select("osm_id", "seconds"), None)


def documents(tables: dict[str, DataFrame], m: MappingSet) -> DataFrame:
    """(osm_id, geom_type, tables, fields): an object per element and type of geometry, with the columns of all tables that it is in."""
    parts = []
    for name, df in tables.items():
        kind = F.upper(geo.st_kind("geometry"))
        columns = [c for c in df.columns if c not in ("osm_id", "geometry")]
        entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns])
        parts.append(df.select("osm_id", kind.alias("geom_type"), F.lit(name).alias("table"), F.map_from_entries(F.filter(entries, lambda x: x["value"].isNotNull())).alias("fields")))
    return O.documents(reduce(DataFrame.unionByName, parts))


def write_documents(staging: Staging, m: MappingSet, path: str, o: Options = Options()) -> None:
    """Write the import as JSON objects instead of tables."""
    keep, done = staging.keeper()
    try:
        documents(base_tables(staging.load(), m, o, keep), m).write.mode("error").json(path)
    finally:
        done()


def _mended(df: DataFrame, name: str, m: MappingSet) -> DataFrame:
    """df, repaired if a Repair names it."""
    return derived.repaired(df) if any(r.origin == name for r in m.repairs) else df


def derived_tables(tables: dict[str, DataFrame], m: MappingSet) -> dict[str, DataFrame]:
    """These and their generalized tables, with repaired polygons where declared; what is made of a repaired table has its repaired polygons."""
    out = {name: _mended(df, name, m) for name, df in tables.items()}
    for g in derived.in_order([g for g in m.generalized], tables):
        out[g.name] = _mended(derived.generalized(out[g.origin], g.tolerance, g.where), g.name, m)
    return out


def union_views(tables: dict[str, DataFrame], m: MappingSet) -> dict[str, DataFrame]:
    classes = {t.name: t.classname or t.name for t in m.tables} | {g.name: g.origin for g in m.generalized}
    return {v.name: O.union_view({t: tables[t] for t in v.tables}, dict(v.fields), classes=classes) for v in m.unions if all(t in tables for t in v.tables)}


def write(spark: SparkSession, staging: Staging, m: MappingSet, o: Options = Options(), p: Prefixes = Prefixes(), dry: bool = False) -> list[str]:
    """Write all tables under the import prefix, derived ones from the written ones; then the views.

    What could not be made is in staging.rejects() afterwards, slow relations in staging.slow_relations().
    """
    if dry:
        for df in derived_tables(base_tables(staging.load(), m, o), m).values():
            df.write.format("noop").mode("overwrite").save()
        return []
    keep, clean = staging.keeper()

    def keep_all(name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        if name not in ("rejects", "slow"):
            return keep(name, df, by)
        df.write.mode("overwrite").parquet(staging.path(name))
        return df

    try:
        done: dict[str, DataFrame] = {}

        def make(tables: dict[str, DataFrame]) -> None:
            """Write tables that are not made of one another."""
            together(spark, [lambda n=name, df=_mended(df, name, m): create(spark, p.new + n, clustered(df), _indexed(m, n)) for name, df in tables.items()])
            done.update({name: spark.table(p.new + name).select(*df.columns) for name, df in tables.items()})

        make(base_tables(staging.load(), m, o, keep_all))
        waiting = derived.in_order(m.generalized, done)
        while waiting:
            ready = [g for g in waiting if g.origin in done]
            make({g.name: derived.generalized(done[g.origin], g.tolerance, g.where) for g in ready})
            waiting = [g for g in waiting if g not in ready]
    finally:
        clean()
    return [p.new + n for n in done] + create_views(spark, m, p.new)


def _indexed(m: MappingSet, name: str) -> tuple[str, ...]:
    """The columns that a table, or the one it is generalized from, declares as indexed."""
    origins = {g.name: g.origin for g in m.generalized}
    while name in origins:
        name = origins[name]
    return tuple(f.name for f in m.table(name).columns(m.default_name) if f.indexed)
