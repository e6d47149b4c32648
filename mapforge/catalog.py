"""Feature tables in Spark's catalog: written under an import prefix, swapped into production, taken back, removed.

Names are lower case and matched by exact prefix: of several prefixes a table belongs to the longest
that fits, so ``osm_`` never claims what lies under ``osm_new_``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import parse_qsl, unquote_plus, urlsplit

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geo
from .mapping import MappingSet, UnionView


def prefix(text: str) -> str:
    """A prefix with one underscore behind it."""
    return text.lower().rstrip("_") + "_"


@dataclass(frozen=True)
class Prefixes:
    new: str = "osm_new_"
    production: str = "osm_"
    backup: str = "osm_old_"

    def __post_init__(self) -> None:
        for name in ("new", "production", "backup"):
            object.__setattr__(self, name, prefix(getattr(self, name)))
        if len({self.new, self.production, self.backup}) < 3:
            raise ValueError("the prefixes must differ")

    def owner(self, table: str) -> str | None:
        fits = [p for p in (self.new, self.production, self.backup) if table.startswith(p)]
        return max(fits, key=len) if fits else None


@dataclass(frozen=True)
class Sink:
    """Where tables go: ``scheme://user:password@host:port/database?option=value``."""

    scheme: str
    host: str | None
    port: int | None
    database: str
    user: str | None
    password: str | None
    options: tuple[tuple[str, str], ...] = ()


def parse_sink(url: str) -> Sink:
    u = urlsplit(url)
    if not u.scheme:
        raise ValueError(f"not a connection: {url}")
    secret = None if u.password is None else unquote_plus(u.password)
    return Sink(u.scheme, u.hostname, u.port, u.path.lstrip("/"), None if u.username is None else unquote_plus(u.username), secret, tuple(parse_qsl(u.query)))


def probe(spark: SparkSession, database: str) -> str | None:
    """None if tables can go there, else why not."""
    return None if spark.catalog.databaseExists(database) else f"there is no database {database}"


def _names(spark: SparkSession, p: Prefixes, which: str) -> tuple[list[str], list[str]]:
    """(tables, views) of a prefix in the current database."""
    found = [t for t in spark.catalog.listTables() if not t.isTemporary and p.owner(t.name.lower()) == which]
    return sorted(t.name.lower() for t in found if t.tableType != "VIEW"), sorted(t.name.lower() for t in found if t.tableType == "VIEW")


def _drop(spark: SparkSession, name: str) -> None:
    own = f"`{spark.catalog.currentDatabase()}`.`{name}`"  # never a temporary view
    if spark.catalog.tableExists(own):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(own).tableType == 'VIEW' else 'TABLE'} {own}")


def together(spark: SparkSession, steps: Sequence[Callable[[], object]], threads: int = 8) -> None:
    """Run steps that don't need one another at the same time: one table's few tasks leave most cores idle.

    After a failure no further step begins, and it is raised when those under way have ended.
    """
    failed: list[BaseException] = []

    def run(step: Callable[[], object]) -> None:
        if not failed:
            try:
                step()
            except BaseException as x:
                failed.append(x)

    with ThreadPoolExecutor(threads) as pool:
        for step in steps:
            pool.submit(inheritable_thread_target(spark)(run), step)
    if failed:
        raise failed[0]


def clustered(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows that lie together stored together, with bounds that Parquet can prune by."""
    if "geometry" not in df.columns:
        return df
    placed = df.withColumn("_b", geo.st_bounds("geometry")).withColumn("_z", geo.z_cell(F.col("_b")))
    ranged = placed.repartitionByRange(partitions, "_z") if partitions else placed.repartitionByRange("_z")
    bounds = [F.col(f"_b.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")]
    return ranged.sortWithinPartitions("_z").select(*df.columns, *[b for b, c in zip(bounds, ("minx", "miny", "maxx", "maxy"), strict=True) if c not in df.columns])


def create(spark: SparkSession, name: str, df: DataFrame, indexed: tuple[str, ...] = ()) -> None:
    """Write a table in place of a table or view of this name; ``indexed`` columns are noted in its properties.

    The rows are written under another name first, so a failure leaves what was there.
    """
    name = name.lower()
    fresh = f"{name}__writing"
    _drop(spark, fresh)
    df.write.format("parquet").saveAsTable(fresh)
    _drop(spark, name)
    spark.sql(f"ALTER TABLE `{fresh}` RENAME TO `{name}`")
    if indexed:
        spark.sql(f"ALTER TABLE `{name}` SET TBLPROPERTIES ('indexed' = '{json.dumps(indexed)}')")


def optimize(spark: SparkSession, p: Prefixes = Prefixes()) -> list[str]:
    """Rewrite the import's tables in the order of their places and gather statistics."""
    tables = _names(spark, p, p.new)[0]

    def rewrite(t: str) -> None:
        df = spark.table(t)
        if "geometry" in df.columns:
            noted = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{t}`").collect() if r["key"] == "indexed"]
            create(spark, t, clustered(df), tuple(json.loads(noted[0])) if noted else ())
        spark.sql(f"ANALYZE TABLE `{t}` COMPUTE STATISTICS")

    together(spark, [lambda t=t: rewrite(t) for t in tables])
    return tables


def view_sql(spark: SparkSession, view: UnionView, m: MappingSet, at: str) -> str | None:
    """The statement of a union view over the tables of a prefix; None if there are none of them."""
    origin = {g.name: g.origin for g in m.generalized}
    there = [t for t in view.tables if spark.catalog.tableExists(at + t)]
    wanted = {"name": "", **dict(view.fields)}
    wanted |= {} if "type" in wanted else {"type": None}

    def literal(v: object) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else repr(v)

    types: dict[str, str] = {}
    for t in there:
        types |= {n: k for n, k in spark.table(at + t).dtypes if n not in types}
    parts = []
    for t in there:
        columns = spark.table(at + t).columns
        cols = [f"CAST({f'`{c}`' if c in columns else literal(d)} AS {types.get(c, 'string')}) AS `{c}`" for c, d in wanted.items()]
        shape = ["geometry"] if "geometry" in columns else []
        named = next((s.classname or s.name for s in m.tables if s.name == t), origin.get(t, t))
        parts.append(f"SELECT {', '.join(['osm_id', *shape, *cols])}, '{named}' AS class FROM `{at}{t}`")
    return f"CREATE OR REPLACE VIEW `{at}{view.name}` AS {' UNION ALL '.join(parts)}" if parts else None


def create_views(spark: SparkSession, m: MappingSet, at: str) -> list[str]:
    made = []
    for view in m.unions:
        sql = view_sql(spark, view, m, at)
        if sql:
            spark.sql(sql)
            made.append(at + view.name)
    return made


def _swap(spark: SparkSession, p: Prefixes, new: str, production: str, backup: str) -> list[str]:
    tables = _names(spark, p, new)[0]
    if not tables:
        raise RuntimeError(f"no tables begin with {new}")
    remove(spark, p, backup)
    for source in (new, production):
        for v in _names(spark, p, source)[1]:
            spark.sql(f"DROP VIEW `{v}`")
    for source, target in ((production, backup), (new, production)):
        for t in _names(spark, p, source)[0]:
            spark.sql(f"ALTER TABLE `{t}` RENAME TO `{target}{t[len(source):]}`")
    return [production + t[len(new) :] for t in tables]


def deploy(spark: SparkSession, m: MappingSet, p: Prefixes = Prefixes()) -> list[str]:
    """Production tables become the backup, the import's tables production; the old backup goes. RuntimeError without an import."""
    done = _swap(spark, p, p.new, p.production, p.backup)
    create_views(spark, m, p.production)
    create_views(spark, m, p.backup)
    return done


def recover(spark: SparkSession, m: MappingSet, p: Prefixes = Prefixes()) -> list[str]:
    """The backup becomes production again, production the import; tables of an import not yet deployed go."""
    done = _swap(spark, p, p.backup, p.production, p.new)
    create_views(spark, m, p.production)
    create_views(spark, m, p.new)
    return done


def remove(spark: SparkSession, p: Prefixes, which: str) -> list[str]:
    """Drop a prefix's views, then its tables."""
    tables, views = _names(spark, p, which)
    for v in views:
        spark.sql(f"DROP VIEW `{v}`")
    for t in tables:
        spark.sql(f"DROP TABLE `{t}`")
    return views + tables
