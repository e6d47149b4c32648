"""Declared feature tables and what is derived from them."""

from __future__ import annotations

import json
import runpy
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from .functions.fields import Field, Name, Type

ANY = "__any__"
RELATION_TYPES = ("multipolygon", "boundary", "land_area")
_SEP = "\u0001"


@dataclass(frozen=True)
class TableSpec:
    """A table of points, lines or polygons: the tags that lead to it and its columns."""

    name: str
    kind: str  # point, line or polygon
    mapped: dict[str, tuple[str, ...]]
    fields: tuple[Field, ...] = ()
    field_filter: tuple[Field, ...] = ()
    with_type: bool = True
    skip_inserted: bool = True  # polygons: a way that made a relation's polygon is not a polygon again
    classname: str | None = None

    def columns(self, default_name: Field = Name()) -> tuple[Field, ...]:
        names = {f.name for f in self.fields}
        head = () if "name" in names else (default_name,)
        return head + (() if not self.with_type or "type" in names else (Type(),)) + self.fields

    def derive(self, **changes) -> TableSpec:
        return replace(self, **changes)


@dataclass(frozen=True)
class Generalized:
    name: str
    origin: str
    tolerance: float
    where: str | None = None


@dataclass(frozen=True)
class UnionView:
    name: str
    tables: tuple[str, ...]
    fields: tuple[tuple[str, object], ...] = ()


@dataclass(frozen=True)
class Repair:
    name: str
    origin: str


@dataclass(frozen=True)
class MappingSet:
    tables: tuple[TableSpec, ...]
    generalized: tuple[Generalized, ...] = ()
    unions: tuple[UnionView, ...] = ()
    repairs: tuple[Repair, ...] = ()
    default_name: Field = field(default_factory=Name)
    keep_keys: tuple[str, ...] = ()

    def table(self, name: str) -> TableSpec:
        return next(t for t in self.tables if t.name == name)

    def of(self, *kinds: str) -> list[TableSpec]:
        return [t for t in self.tables if t.kind in kinds]

    def allowed(self, *kinds: str) -> dict[str, list[str]]:
        """Key to the values that the tag filter keeps for tables of these kinds."""
        out: dict[str, set[str]] = {k: {ANY} for k in self.keep_keys}
        for t in self.of(*kinds):
            for k, values in t.mapped.items():
                out.setdefault(k, set()).update(values)
            for f in (*t.columns(self.default_name), *t.field_filter):
                for k in f.keys:
                    out.setdefault(k, set()).add(ANY)
        return {k: sorted(v) for k, v in out.items()}

    def rules(self, *kinds: str) -> dict[str, list[str]]:
        """key SEP value to the tables that it leads to, in order of declaration."""
        out: dict[str, list[str]] = {}
        for t in self.of(*kinds):
            for k, values in t.mapped.items():
                for v in values:
                    out.setdefault(k + _SEP + v, []).append(t.name)
        return out


def load_mapping(path: str, name: str = "MAPPING") -> MappingSet:
    """The MappingSet that a Python file defines under name."""
    return runpy.run_path(path)[name]


def _literal(table: dict[str, list[str]]) -> Column:
    return F.from_json(F.lit(json.dumps(table)), "map<string,array<string>>")


def filtered(tags: Column, allowed: dict[str, list[str]]) -> Column:
    """The tags that some table reads; a name alone is nothing."""
    table = _literal(allowed)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = F.coalesce(tags, none)

    def keep(k: Column, v: Column) -> Column:
        values = F.try_element_at(table, k)
        return F.coalesce(F.array_contains(values, ANY) | F.array_contains(values, v), F.lit(False))

    kept = F.map_filter(tags, keep)
    return F.when((F.size(kept) == 1) & F.map_contains_key(kept, "name"), none).otherwise(kept)


def node_tags(tags: Column, m: MappingSet) -> Column:
    return filtered(tags, m.allowed("point"))


def way_tags(tags: Column, m: MappingSet) -> Column:
    return filtered(tags, m.allowed("line", "polygon"))


def relation_tags(tags: Column, m: MappingSet) -> Column:
    """Only polygon relations keep tags; one that lost tags and has but type and name left keeps none."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = F.coalesce(tags, none)
    kind = F.try_element_at(tags, F.lit("type"))
    allowed = m.allowed("line", "polygon")
    allowed["type"] = sorted(RELATION_TYPES)
    kept = filtered(tags, allowed)
    others = F.size(F.filter(F.map_keys(kept), lambda k: ~k.isin("type", "name")))
    return (
        F.when(~F.coalesce(kind.isin(*RELATION_TYPES), F.lit(False)), none)
        .when((kind == "boundary") & ~F.map_contains_key(tags, "boundary"), none)
        .when((F.size(kept) < F.size(tags)) & (others == 0), none)
        .otherwise(kept)
    )


def routes(tags: Column, rules: dict[str, list[str]]) -> Column:
    """array<struct(table, key, value)>: each table once, by the tag whose key is last in order of code points.

    The whole lookup is an expression over a literal map, so elements are routed without a shuffle.
    """
    table = _literal(rules)
    none = F.array().cast("array<string>")

    def of(e: Column) -> Column:
        exact = F.coalesce(F.try_element_at(table, F.concat(e["key"], F.lit(_SEP), e["value"])), none)
        wild = F.coalesce(F.try_element_at(table, F.concat(e["key"], F.lit(_SEP + ANY))), none)
        return F.transform(F.concat(exact, wild), lambda t: F.struct(t.alias("table"), e["key"].alias("key"), e["value"].alias("value")))

    found = F.flatten(F.transform(F.sort_array(F.map_entries(tags), asc=False), of))
    return F.transform(F.array(found), lambda r: F.filter(r, lambda x, i: i == F.array_position(r["table"], x["table"]) - 1))[0]
