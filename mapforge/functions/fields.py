"""Field types: how a column of a feature table is derived from tags, the matched key and value, and geometry.

Each field is a frozen dataclass that compiles to a Catalyst expression. ``keys`` are the tags it reads
(None: its own name); ``drops`` is the condition on which the element is not in the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that say nothing, compared in lower case and untrimmed.
JUNK_NAMES = (
    "fixme", "fix me", "fix-me!", "0", "none", "n/a", "s/n", "kein name", "kein", "unbenannt", "unbekannt",
    "noch unbekannt", "noch ohne namen", "noname", "unnamed", "namenlos", "no_name", "no name", "editme", "_edit_me_",
)
# Ranks of road types, others 0.
ROAD_RANKS = {
    "minor": 3, "road": 3, "unclassified": 3, "residential": 3, "tertiary_link": 3, "secondary_link": 3, "primary_link": 3,
    "trunk_link": 3, "motorway_link": 3, "tertiary": 4, "secondary": 5, "primary": 6, "trunk": 8, "motorway": 9,
}
RAIL_RANK = 7


def stripped(v: Column) -> Column:
    return F.lower(F.regexp_replace(v, r"^\s+|\s+$", ""))


@dataclass(frozen=True)
class Row:
    """What a field sees of a routed element."""

    tags: Column
    key: Column
    value: Column
    area: Column | None = None  # of the geometry in square degrees
    mid_lat: Column | None = None


@dataclass(frozen=True)
class Field:
    name: str
    sql_type: str = field(default="string", kw_only=True)
    indexed: bool = field(default=False, kw_only=True)  # noted in the table's properties; rows are not sorted by it

    @property
    def keys(self) -> list[str]:
        return [self.name]

    def tag(self, row: Row) -> Column:
        return F.try_element_at(row.tags, F.lit(self.name))

    def expr(self, row: Row) -> Column:
        return self.tag(row)

    def drops(self, row: Row) -> Column | None:
        return None

    @staticmethod
    def from_function(name: str, function: Callable[[str | None], object], sql_type: str, **options) -> Field:
        """A field that a Python function makes of the tag of its name (None without it), in Arrow batches. Built-in columns are faster: see Custom."""

        @F.pandas_udf(sql_type)
        def made(values: pd.Series) -> pd.Series:
            return pd.Series([function(v) for v in values], dtype=object)

        return Custom(name, lambda row: made(F.try_element_at(row.tags, F.lit(name))), (name,), sql_type=sql_type, **options)


@dataclass(frozen=True)
class String(Field):
    pass


@dataclass(frozen=True)
class Name(Field):
    """The tag; a junk name is empty, a missing one null."""

    name: str = "name"

    def expr(self, row: Row) -> Column:
        v = self.tag(row)
        return F.when(F.lower(v).isin(*JUNK_NAMES), F.lit("")).otherwise(v)


@dataclass(frozen=True)
class LocalizedName(Field):
    """The first tag of ``choices`` that is neither empty nor junk, else empty."""

    name: str = "name"
    choices: tuple[str, ...] = ("name", "int_name")

    @property
    def keys(self) -> list[str]:
        return list(self.choices)

    def expr(self, row: Row) -> Column:
        found = [F.try_element_at(row.tags, F.lit(k)) for k in self.choices]
        return F.coalesce(*[F.when((v != "") & ~F.lower(v).isin(*JUNK_NAMES), v) for v in found], F.lit(""))


@dataclass(frozen=True)
class Type(Field):
    """The value that put the element in the table."""

    name: str = "type"

    @property
    def keys(self) -> list[str]:
        return []

    def expr(self, row: Row) -> Column:
        return row.value


@dataclass(frozen=True)
class Class(Type):
    """The key that put the element in the table."""

    name: str = "class"

    def expr(self, row: Row) -> Column:
        return row.key


@dataclass(frozen=True)
class Bool(Field):
    """1 unless the tag is missing or says no; with default False the words that say yes give 0 instead."""

    default: bool = True
    negative: tuple[str, ...] | None = None
    sql_type: str = field(default="smallint", kw_only=True)

    def expr(self, row: Row) -> Column:
        words = self.negative or (("false", "no", "0", "undefined") if self.default else ("true", "yes", "1", "undefined"))
        return F.when(F.coalesce(stripped(self.tag(row)).isin(*words), F.lit(True)), 0).otherwise(1).cast("smallint")


@dataclass(frozen=True)
class Direction(Field):
    """1 along, -1 against, 0 both ways."""

    sql_type: str = field(default="smallint", kw_only=True)

    def expr(self, row: Row) -> Column:
        v = stripped(self.tag(row))
        return F.when(v.isin("yes", "true", "1"), 1).when(v == "-1", -1).otherwise(0).cast("smallint")


@dataclass(frozen=True)
class OneOfInt(Field):
    """The tag as a number if it is one of ``values`` to the letter; else the element is dropped."""

    values: tuple[str, ...] = ()
    sql_type: str = field(default="smallint", kw_only=True)

    def expr(self, row: Row) -> Column:
        return self.tag(row).try_cast("smallint")

    def drops(self, row: Row) -> Column | None:
        return ~F.coalesce(self.tag(row).isin(*self.values), F.lit(False))


@dataclass(frozen=True)
class Integer(Field):
    """The tag as an integer, null if it is none."""

    sql_type: str = field(default="int", kw_only=True)

    def expr(self, row: Row) -> Column:
        v = F.regexp_replace(self.tag(row), r"^\s+|\s+$", "")
        return F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast("int"))


@dataclass(frozen=True)
class ZOrder(Field):
    """The place of the value among ``types`` from the end; unlisted values 0."""

    name: str = "z_order"
    types: tuple[str, ...] = ()
    sql_type: str = field(default="smallint", kw_only=True)

    @property
    def keys(self) -> list[str]:
        return []

    def expr(self, row: Row) -> Column:
        place = F.array_position(F.array(*[F.lit(t) for t in reversed(self.types)]), row.value)
        return F.greatest(F.coalesce(place, F.lit(0)) - 1, F.lit(0)).cast("smallint")


@dataclass(frozen=True)
class WayZOrder(Field):
    """Ten per layer and bridge, minus ten per tunnel, plus the rank of the road type (railways 7)."""

    name: str = "z_order"
    sql_type: str = field(default="smallint", kw_only=True)

    @property
    def keys(self) -> list[str]:
        return []  # so the tag filter drops ``layer`` unless it is kept on purpose

    def expr(self, row: Row) -> Column:
        rank = F.lit(None)
        for t, r in ROAD_RANKS.items():
            rank = F.when(row.value == t, r).otherwise(rank)
        rank = F.coalesce(rank, F.when(F.map_contains_key(row.tags, "railway"), RAIL_RANK).otherwise(0))
        layer = F.coalesce(Integer("layer").expr(row), F.lit(0))
        return (layer * 10 + rank - Bool("tunnel").expr(row) * 10 + Bool("bridge").expr(row) * 10).cast("smallint")


@dataclass(frozen=True)
class PseudoArea(Field):
    """Square metres, roughly: the area in degrees scaled at the middle latitude; null for no area."""

    name: str = "area"
    sql_type: str = field(default="float", kw_only=True)

    @property
    def keys(self) -> list[str]:
        return []

    def expr(self, row: Row) -> Column:
        side = F.sqrt(row.area * F.cos(F.radians(row.mid_lat))) * F.lit(40075160.0 / 360)
        return F.when(row.area > 0, side * side)


@dataclass(frozen=True)
class Custom(Field):
    """A column by any function of the routed element; ``reads`` are the tags it needs."""

    make: Callable[[Row], Column] = lambda row: F.lit(None)
    reads: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return list(self.reads)

    def expr(self, row: Row) -> Column:
        return self.make(row)


def meter_to_mapunit(meter: float, geographic: bool) -> float:
    return meter / (40000 * 1000 / 360) if geographic else float(meter)


def sqr_meter_to_mapunit(square: float, geographic: bool) -> float:
    return meter_to_mapunit(math.sqrt(square), geographic) ** 2
