"""The command line: ``python -m mapforge.cli --read a.osm.pbf --write --optimize --deploy``."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from . import catalog, engine
from .defaults import MAPPING
from .mapping import MappingSet, load_mapping
from .sources.areas import load_area


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mapforge", description="Feature tables of OpenStreetMap extracts.")
    p.add_argument("files", nargs="*", help="extracts to read")
    p.add_argument("-m", "--mapping-file", help="a Python file that defines MAPPING")
    p.add_argument("-d", "--database", help="the catalog's database")
    p.add_argument("--host", help="the host of the catalog's metastore")
    p.add_argument("--port", type=int, help="its port (9083)")
    p.add_argument("-U", "--user", help="as whom to use cluster and metastore")
    p.add_argument("--connection", help="all of these: catalog://user@host:port/database?proj=EPSG:3857&prefix=osm_new_")
    p.add_argument("--proj", help="EPSG code of the tables (900913)")
    p.add_argument("--debug", action="store_true", help="tracebacks, and Spark's messages")
    p.add_argument("-q", "--quiet", action="store_true", help="print nothing but errors")
    p.add_argument("-c", "--concurrency", type=int, help="cores, where no cluster is given")
    p.add_argument("--cache-dir", default="staging")
    kept = p.add_mutually_exclusive_group()
    kept.add_argument("--merge-cache", action="store_true")
    kept.add_argument("--overwrite-cache", action="store_true")
    p.add_argument("--table-prefix", help="osm_new_")
    p.add_argument("--table-prefix-production", default="osm_")
    p.add_argument("--table-prefix-backup", default="osm_old_")
    for verb in ("read", "write", "optimize", "deploy-production-tables", "recover-production-tables", "remove-backup-tables"):
        p.add_argument(f"--{verb}", action="store_true")
    p.add_argument("-n", "--dry-run", action="store_true")
    p.add_argument("--limit-to", help="WKT, GeoJSON or .shp")
    p.add_argument("--limit-to-where", help="a predicate on the features of --limit-to")
    p.add_argument("--relation-builder", choices=("contains", "union"), default="contains")
    p.add_argument("--import-partial-relations", action="store_true")
    p.add_argument("--split-lines", type=int, default=0, metavar="VERTICES")
    p.add_argument("--max-rings", type=int, default=int(os.environ.get("MAPFORGE_MAX_RINGS", 0)))
    p.add_argument("--report-slow", type=float, default=float(os.environ.get("MAPFORGE_REPORT_SLOW", 60)), metavar="SECONDS", help="report relations that take so long")
    p.add_argument("--documents", metavar="FOLDER", help="write JSON objects there instead of tables")
    return p


def session(a: argparse.Namespace) -> SparkSession:
    """A session on the metastore that the arguments name, if they do."""
    builder = SparkSession.builder.appName("mapforge")
    if a.concurrency:
        builder = builder.master(f"local[{a.concurrency}]")
    if a.host:
        builder = builder.config("spark.hadoop.hive.metastore.uris", f"thrift://{a.host}:{a.port or 9083}").enableHiveSupport()
    if a.user:
        os.environ["HADOOP_USER_NAME"] = a.user
    spark = builder.getOrCreate()
    if not a.debug:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if a.debug:
        return _run(a, spark)
    try:
        return _run(a, spark)
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2


def _run(a: argparse.Namespace, spark: SparkSession | None) -> int:
    p = parser()
    say = (lambda text: None) if a.quiet else print
    if not (a.read or a.write or a.optimize or a.deploy_production_tables or a.recover_production_tables or a.remove_backup_tables):
        p.print_help()
        return 1
    if a.deploy_production_tables and a.recover_production_tables:
        p.error("deploy or recover, not both")
    if a.read and not a.files:
        p.error("no files to read")
    sink = catalog.parse_sink(a.connection) if a.connection else None
    options = dict(sink.options) if sink else {}
    database = a.database or (sink.database if sink else None)
    if sink:
        a.host, a.port, a.user = a.host or sink.host, a.port or sink.port, a.user or sink.user
    proj, new = a.proj or options.get("proj", "900913"), a.table_prefix or options.get("prefix", "osm_new_")
    if not database and not a.dry_run and (a.write and not a.documents or a.optimize or a.deploy_production_tables or a.recover_production_tables or a.remove_backup_tables):
        p.error("-d or --connection says where the tables are")
    spark = spark or session(a)
    if database:
        wrong = catalog.probe(spark, database)
        if wrong:
            print(wrong, file=sys.stderr)
            return 2
        spark.catalog.setCurrentDatabase(database)
    m: MappingSet = load_mapping(a.mapping_file) if a.mapping_file else MAPPING
    prefixes = catalog.Prefixes(new, a.table_prefix_production, a.table_prefix_backup)
    staging = engine.Staging(spark, a.cache_dir)
    if a.read:
        if staging.exists() and not (a.merge_cache or a.overwrite_cache):
            print(f"{a.cache_dir} holds elements already: --merge-cache or --overwrite-cache", file=sys.stderr)
            return 2
        staging.save(engine.merged(engine.read(spark, a.files)), m, "merge" if a.merge_cache else "overwrite")
    if a.write:
        limit = load_area(spark, a.limit_to, a.limit_to_where) if a.limit_to else None
        o = engine.Options(int(proj.upper().removeprefix("EPSG:")), a.split_lines, a.relation_builder, a.import_partial_relations, a.max_rings, limit, a.report_slow)
        if a.documents and not a.dry_run:
            engine.write_documents(staging, m, a.documents, o)
        else:
            made = engine.write(spark, staging, m, o, prefixes, a.dry_run)
            if made:
                say(f"{len(made)} tables and views; left out: {staging.rejects().count()} elements; slow relations: {staging.slow_relations().count()}")
    if not a.dry_run:
        if a.optimize:
            catalog.optimize(spark, prefixes)
        if a.deploy_production_tables:
            catalog.deploy(spark, m, prefixes)
        if a.recover_production_tables:
            catalog.recover(spark, m, prefixes)
        if a.remove_backup_tables:
            catalog.remove(spark, prefixes, prefixes.backup)
    return 0


if __name__ == "__main__":
    sys.exit(main())
