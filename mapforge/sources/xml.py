"""OpenStreetMap XML, plain or .bz2, by Spark's XML reader: one lazy DataFrame per kind of element."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TAGS = "tag array<struct<_k:string,_v:string>>"


@dataclass(frozen=True)
class Elements:
    coords: DataFrame
    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame


def _tags() -> Column:
    """Tags as a map; of a key given twice the last value counts, and no tags are an empty map."""
    tags = F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>"))
    last = F.filter(tags, lambda t, i: ~F.exists(F.slice(tags, i + 2, F.size(tags)), lambda u: u["_k"] == t["_k"]))
    return F.map_from_entries(F.transform(last, lambda t: F.struct(t["_k"].alias("key"), t["_v"].alias("value"))))


def read_osm(spark: SparkSession, paths: str | list[str]) -> Elements:
    """Every node is a coord; nodes are those with tags. Untagged ways stay: relations may need them."""
    paths = ",".join([paths] if isinstance(paths, str) else paths)
    read = lambda kind, schema: spark.read.format("xml").option("rowTag", kind).schema(schema).load(paths)
    points = read("node", f"_id long, _lat double, _lon double, {_TAGS}").select(F.col("_id").alias("osm_id"), _tags().alias("tags"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"))
    ways = read("way", f"_id long, nd array<struct<_ref:long>>, {_TAGS}")
    relations = read("relation", f"_id long, member array<struct<_type:string,_ref:long,_role:string>>, {_TAGS}")
    members = F.transform(F.coalesce("member", F.array().cast("array<struct<_type:string,_ref:bigint,_role:string>>")), lambda m: F.struct(m["_ref"].alias("ref"), m["_type"].alias("type"), m["_role"].alias("role")))
    return Elements(
        coords=points.select("osm_id", "lon", "lat"),
        nodes=points.where(F.size("tags") > 0),
        ways=ways.select(F.col("_id").alias("osm_id"), _tags().alias("tags"), F.coalesce(F.col("nd._ref"), F.array().cast("array<bigint>")).alias("refs")),
        relations=relations.select(F.col("_id").alias("osm_id"), _tags().alias("tags"), members.alias("members")),
    )
