"""The default mapping: which tags lead to which of the usual rendering tables."""

from __future__ import annotations

from .functions.fields import Bool, Direction, Integer, OneOfInt, PseudoArea, String, WayZOrder, ZOrder
from .mapping import ANY, Generalized, MappingSet, Repair, TableSpec, UnionView

# The tags of the default tables, in their order (the order of places and land uses is their z order).
PLACES = ("country", "state", "region", "county", "city", "town", "village", "hamlet", "suburb", "locality")
MOTORWAYS = ("motorway", "motorway_link", "trunk", "trunk_link")
MAINROADS = ("primary", "primary_link", "secondary", "secondary_link", "tertiary")
MINORROADS = ("road", "path", "track", "service", "footway", "bridleway", "cycleway", "steps", "pedestrian", "living_street", "unclassified", "residential")
RAILWAYS = ("rail", "tram", "light_rail", "subway", "narrow_gauge", "preserved", "funicular", "monorail")
STOPS = {
    "highway": ("motorway_junction", "turning_circle", "bus_stop"),
    "railway": ("station", "halt", "tram_stop", "crossing", "level_crossing", "subway_entrance"),
    "aeroway": ("aerodome", "terminal", "helipad", "gate"),
}
LANDUSES = {
    "landuse": (
        "park", "forest", "residential", "retail", "commercial", "industrial", "railway", "cemetery", "grass", "farmyard",
        "farm", "farmland", "wood", "meadow", "village_green", "recreation_ground", "allotments", "quarry",
    ),
    "leisure": ("park", "garden", "playground", "golf_course", "sports_centre", "pitch", "stadium", "common", "nature_reserve"),
    "natural": ("wood", "land", "scrub"),
    "highway": ("pedestrian", "footway"),
    "amenity": ("university", "school", "college", "library", "fuel", "parking", "cinema", "theatre", "place_of_worship", "hospital"),
}
LANDUSE_ORDER = (
    "pedestrian", "footway", "playground", "park", "forest", "cemetery", "farmyard", "farm", "farmland", "wood", "meadow",
    "grass", "village_green", "recreation_ground", "garden", "sports_centre", "pitch", "common", "allotments", "golf_course",
    "university", "school", "college", "library", "fuel", "parking", "nature_reserve", "cinema", "theatre",
    "place_of_worship", "hospital", "scrub", "quarry", "residential", "retail", "commercial", "industrial", "railway", "land",
)
AMENITIES = ("university", "school", "library", "fuel", "hospital", "fire_station", "police", "townhall")

_road = (Bool("tunnel"), Bool("bridge"), Direction("oneway"), String("ref"), WayZOrder())


def _roads(name: str, values: tuple[str, ...]) -> TableSpec:
    return TableSpec(name, "line", {"highway": values}, _road, field_filter=(Bool("area"),))


def _levels(name: str, *, coarse: float = 200, fine: float = 50) -> tuple[Generalized, ...]:
    return Generalized(f"{name}_gen1", name, fine), Generalized(f"{name}_gen0", f"{name}_gen1", coarse)


def _areas(name: str) -> tuple[Generalized, ...]:
    return Generalized(f"{name}_gen0", name, 200, "ST_Area(geometry) > 500000"), Generalized(f"{name}_gen1", name, 50, "ST_Area(geometry) > 50000")


_ROAD_DEFAULTS = (("bridge", 0), ("ref", None), ("tunnel", 0), ("oneway", 0), ("z_order", 0))

MAPPING = MappingSet(
    tables=(
        TableSpec("places", "point", {"place": PLACES}, (ZOrder("z_order", PLACES), Integer("population"))),
        TableSpec("admin", "polygon", {"boundary": ("administrative",)}, (OneOfInt("admin_level", tuple("123456")),), skip_inserted=False),
        _roads("motorways", MOTORWAYS),
        _roads("mainroads", MAINROADS),
        TableSpec("buildings", "polygon", {"building": (ANY,)}),
        _roads("minorroads", MINORROADS),
        TableSpec("transport_points", "point", STOPS, (String("ref"),)),
        TableSpec("railways", "line", {"railway": RAILWAYS}, (Bool("tunnel"), Bool("bridge"), WayZOrder())),
        TableSpec("waterways", "line", {"waterway": ("stream", "river", "canal", "drain")}, field_filter=(Bool("tunnel"),)),
        TableSpec("waterareas", "polygon", {"waterway": ("riverbank",), "natural": ("water",), "landuse": ("basin", "reservoir")}),
        TableSpec("aeroways", "line", {"aeroway": ("runway", "taxiway")}),
        TableSpec("transport_areas", "polygon", {"railway": ("station",), "aeroway": ("aerodrome", "terminal", "helipad", "apron")}),
        TableSpec("landusages", "polygon", LANDUSES, (PseudoArea(), ZOrder("z_order", LANDUSE_ORDER))),
        TableSpec("amenities", "point", {"amenity": AMENITIES}),
    ),
    generalized=(*_levels("motorways"), *_levels("mainroads"), *_levels("railways"), *_areas("landusages"), *_areas("waterareas")),
    unions=(
        UnionView("roads", ("motorways", "mainroads", "minorroads", "railways"), _ROAD_DEFAULTS),
        UnionView("roads_gen1", ("railways_gen1", "mainroads_gen1", "motorways_gen1"), _ROAD_DEFAULTS),
        UnionView("roads_gen0", ("railways_gen0", "mainroads_gen0", "motorways_gen0"), _ROAD_DEFAULTS),
    ),
    repairs=(Repair("landuse_gen1_valid", "landusages_gen1"), Repair("landuse_gen0_valid", "landusages_gen0")),
)
