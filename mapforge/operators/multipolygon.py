"""Polygons of relations: members to rings, rings to shells with holes.

One row holds one relation with its member ways, found by two equi-joins; an Arrow-batched function
builds its geometry. Roles count for nothing: what is a hole follows from containment.
"""

from __future__ import annotations

import bisect
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..geometry import codec, planar
from .elements import resolve

RESULT = (
    "osm_id bigint, tags map<string,string>, geometry binary, area double, mid_lat double, "
    "ways array<bigint>, inserted array<boolean>, reason string, seconds double"
)


class Incomplete(ValueError):
    """A relation whose polygon cannot be built."""


@dataclass
class Ring:
    """A chain of ways: their ids, the vertices' ids and positions, and the tags, where later ways override earlier ones."""

    ways: list[int]
    refs: list[int]
    line: list[tuple[float, float]]
    tags: dict[str, str] = field(default_factory=dict)
    polygons: list[planar.Polygon] = field(default_factory=list)

    @property
    def closed(self) -> bool:
        return len(self.refs) >= 4 and self.refs[0] == self.refs[-1]

    def turned(self) -> Ring:
        return Ring(self.ways, self.refs[::-1], self.line[::-1], self.tags)


def chained(ways: list[Ring]) -> list[Ring]:
    """Ways joined where their ends meet, in order of members and in either direction.

    At an end that three ways or more share, the last one to arrive there takes part.
    """
    ends: dict[int, Ring] = {}
    alive: dict[int, Ring] = {}
    for way in ways:
        if len(way.refs) < 2:
            continue
        current = way
        for at_start in (True, False):
            meet = current.refs[0] if at_start else current.refs[-1]
            other = ends.get(meet)
            if other is None or id(other) not in alive or other is current or current.refs[0] == current.refs[-1]:
                continue
            del alive[id(other)]
            for r in (other.refs[0], other.refs[-1]):
                if ends.get(r) is other:
                    del ends[r]
            first = other if other.refs[-1] == meet else other.turned()
            second = current if current.refs[0] == meet else current.turned()
            current = Ring(first.ways + second.ways, first.refs + second.refs[1:], first.line + second.line[1:], {**other.tags, **current.tags})
            if not at_start:
                break
            # The far end of what was joined must become the end again.
            if current.refs[-1] != way.refs[-1] and current.refs[0] == way.refs[-1]:
                current = current.turned()
        alive[id(current)] = current
        ends[current.refs[0]] = ends[current.refs[-1]] = current
    return list(alive.values())


def rings_of(ways: list[Ring], partial: bool = False) -> list[Ring]:
    """Closed ways, then closed chains of the others; open chains fail the relation, or are left out if it may be partial."""
    rings = [w for w in ways if w.closed]
    joined = chained([w for w in ways if not w.closed])
    rings += [r for r in joined if r.closed]
    if any(not r.closed for r in joined) and not partial:
        raise Incomplete("open ring")
    if not rings:
        raise Incomplete("no ring")
    return rings


def nested(rings: list[Ring]) -> list[planar.Polygon]:
    """Shells with their holes: a ring at odd depth is a hole of the smallest ring around it, at even depth a new shell."""
    rings.sort(key=lambda r: -abs(planar.signed_area(r.line)))
    around: list[int | None] = [None] * len(rings)
    bounds = [planar.bounds(("Polygon", [r.line])) for r in rings]
    # In order of their left ends, a ring meets only those that begin within its own extent.
    by_left = sorted(range(len(rings)), key=lambda i: bounds[i][0])
    lefts = [bounds[i][0] for i in by_left]
    for i, outer in enumerate(rings):
        x0, y0, x1, y1 = bounds[i]
        for j in by_left[bisect.bisect_left(lefts, x0) : bisect.bisect_right(lefts, x1)]:
            b = bounds[j]
            if j > i and b[1] >= y0 and b[2] <= x1 and b[3] <= y1 and planar.ring_contains(outer.line, rings[j].line):
                around[j] = i
    depth = []
    for a in around:
        depth.append(0 if a is None else depth[a] + 1)
    shells = {i: [r.line] for i, r in enumerate(rings) if depth[i] % 2 == 0}
    for i, r in enumerate(rings):
        if depth[i] % 2:
            shells[around[i]].append(r.line)
    return planar.repaired(list(shells.values()))


def united(rings: list[Ring]) -> list[planar.Polygon]:
    """From the largest ring on: one within what is there so far is taken out, any other is added."""
    for r in rings:
        r.polygons = planar.repaired([[r.line]])
        if not r.polygons:
            raise Incomplete("invalid ring")
    size = lambda items: planar.area(codec.gathered("Polygon", items))
    rings.sort(key=lambda r: -size(r.polygons))
    whole = rings[0].polygons
    for r in rings[1:]:
        rest = planar.difference(r.polygons, whole)
        whole = planar.difference(whole, r.polygons) if size(rest) <= 1e-12 * size(r.polygons) else planar.union(whole, r.polygons)
    return whole


def relation_tags(own: dict[str, str], rings: list[Ring]) -> dict[str, str]:
    """The relation's tags but type; those of the largest ring, name and all, if it has no others but a name."""
    kept = {k: v for k, v in own.items() if k != "type"}
    return kept if any(k != "name" for k in kept) else dict(rings[0].tags)


def build(own: dict[str, str], ways: list[Ring], method: str = "contains", partial: bool = False, max_rings: int = 0) -> tuple[list[planar.Polygon], dict[str, str], list[Ring], list[bool]]:
    """(polygons, tags, rings by size, whether each ring's tags say no more than the relation's)."""
    if method not in ("contains", "union"):
        raise ValueError(f"no such way to build relations: {method}")
    rings = rings_of(ways, partial)
    if 0 < max_rings < len(rings):
        raise Incomplete("too many rings")
    found = nested(rings) if method == "contains" else united(rings)
    if not found:
        raise Incomplete("no area")
    tags = relation_tags(own, rings)
    bare = lambda t: {k: v for k, v in t.items() if k not in ("name", "type")}
    return found, tags, rings, [not bare(r.tags) or bare(r.tags) == bare(tags) for r in rings]


def member_ways(relations: DataFrame, ways: DataFrame) -> DataFrame:
    """The ways that are members of some relation."""
    asked = relations.select(F.explode("members").alias("m")).where("m.type = 'way'").select(F.col("m.ref").alias("osm_id")).distinct()
    return ways.join(asked, "osm_id", "left_semi")


def members_with_lines(relations: DataFrame, lines: DataFrame) -> DataFrame:
    """(osm_id, tags, members array of (at, way, refs, lon, lat, tags)) of relations with way members.

    ``lines`` are complete ways (osm_id, tags, refs, line); a member that is none of them has nulls.
    """
    asked = relations.select(F.col("osm_id").alias("rel"), F.posexplode("members").alias("at", "m")).where("m.type = 'way'").select("rel", "at", F.col("m.ref").alias("way"))
    known = lines.select(F.col("osm_id").alias("way"), "refs", F.col("line.lon").alias("lon"), F.col("line.lat").alias("lat"), F.to_json("tags").alias("tags"))
    grouped = asked.join(known, "way", "left").groupBy("rel").agg(F.sort_array(F.collect_list(F.struct("at", "way", "refs", "lon", "lat", "tags"))).alias("members"))
    return relations.select("osm_id", "tags").join(grouped, F.col("osm_id") == F.col("rel")).drop("rel")


def _row(osm_id: int, own: dict[str, str], members: list, method: str, partial: bool, max_rings: int) -> tuple:
    import json

    way_ids = [m["way"] for m in members]
    try:
        ways = []
        for m in members:
            if m["refs"] is None:
                if not partial:
                    raise Incomplete("missing way or vertex")
                continue
            ways.append(Ring([m["way"]], list(m["refs"]), list(zip(m["lon"], m["lat"], strict=True)), json.loads(m["tags"] or "{}")))
        found, tags, rings, flags = build(own, ways, method, partial, max_rings)
    except (ValueError, ArithmeticError, IndexError) as e:  # Incomplete, or what geometry no relation should have
        return osm_id, own, None, None, None, way_ids, [], str(e) or type(e).__name__
    g = codec.gathered("Polygon", found)
    low, high = planar.bounds(g)[1::2]
    said = {w: f for r, f in zip(rings, flags, strict=True) for w in r.ways}
    return osm_id, tags, codec.to_wkb(g), planar.area(g), low + (high - low) / 2, way_ids, [said.get(w, False) for w in way_ids], None


def assembled(relations: DataFrame, ways: DataFrame, coords: DataFrame, method: str = "contains", partial: bool = False, max_rings: int = 0) -> DataFrame:
    """Relations' polygons from elements: see assembled_from. Only ways that are members are resolved."""
    return assembled_from(relations, resolve(member_ways(relations, ways), coords), method, partial, max_rings)


def assembled_from(relations: DataFrame, lines: DataFrame, method: str = "contains", partial: bool = False, max_rings: int = 0) -> DataFrame:
    """Relations' polygons from complete ways (osm_id, tags, refs, line): a null geometry comes with the reason.

    ``ways`` are the members, ``inserted`` whether each says no more than its relation, ``seconds`` what building took.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["osm_id", "tags", "geometry", "area", "mid_lat", "ways", "inserted", "reason", "seconds"]
        for batch in batches:
            rows = []
            for i, t, m in zip(batch["osm_id"], batch["tags"], batch["members"], strict=True):
                began = time.perf_counter()
                rows.append((*_row(i, dict(t if t is not None else {}), list(m), method, partial, max_rings), time.perf_counter() - began))
            yield pd.DataFrame(rows, columns=names)

    return members_with_lines(relations, lines).select("osm_id", "tags", "members").mapInPandas(run, RESULT)
