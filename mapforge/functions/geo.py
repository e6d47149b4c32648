"""Geometry functions on WKB columns, as Arrow-batched UDFs, and under their usual SQL names.

Nulls give null; bytes that are no geometry give null too, so that one bad row never fails a job.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..geometry import codec, planar


def _parsed(data: bytes | None) -> codec.Geometry | None:
    try:
        return codec.from_wkb(data)
    except (ValueError, KeyError, IndexError, TypeError, struct.error):
        return None


def _each(f: Callable, g: pd.Series, *rest: pd.Series) -> pd.Series:
    """f of every geometry and the values beside it."""
    return pd.Series([None if (v := _parsed(x)) is None else f(v, *more) for x, *more in zip(g, *rest, strict=True)], dtype=object)


def _wkb_of_line(rows: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else codec.to_wkb(("LineString", [(p["lon"], p["lat"]) for p in r])) for r in rows], dtype=object)


def _wkb_of_ring(rows: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else codec.to_wkb(("Polygon", [[(p["lon"], p["lat"]) for p in r]])) for r in rows], dtype=object)


def _wkb_of_point(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else codec.to_wkb(("Point", (a, b))) for a, b in zip(x, y, strict=True)], dtype=object)


def _from_text(text: pd.Series) -> pd.Series:
    def one(t: str | None) -> bytes | None:
        try:
            return None if t is None else codec.to_wkb(codec.from_wkt(t))
        except ValueError:
            return None

    return pd.Series([one(t) for t in text], dtype=object)


def _buffer(g: codec.Geometry, width: float) -> bytes | None:
    if width != 0:
        raise ValueError("only a buffer of width 0, which repairs polygons, is defined")
    return codec.to_wkb(codec.gathered("Polygon", planar.repaired(planar.polygons(g))))


#: How coordinate systems map to each other; both codes name the same spherical projection.
_MERCATOR = (3857, 900913)


def _transform(g: codec.Geometry, source: int, target: int) -> bytes | None:
    if source == target or (source in _MERCATOR and target in _MERCATOR):
        return codec.to_wkb(g)
    if source == 4326 and target in _MERCATOR:
        return codec.to_wkb(planar.transformed(g, planar.to_mercator))
    if source in _MERCATOR and target == 4326:
        return codec.to_wkb(planar.transformed(g, planar.from_mercator))
    raise ValueError(f"no way from EPSG:{source} to EPSG:{target}")


point = F.pandas_udf(_wkb_of_point, T.BinaryType())
line = F.pandas_udf(_wkb_of_line, T.BinaryType())
ring = F.pandas_udf(_wkb_of_ring, T.BinaryType())
from_text = F.pandas_udf(_from_text, T.BinaryType())


@F.pandas_udf(T.StringType())
def as_text(g: pd.Series) -> pd.Series:
    return _each(codec.to_wkt, g)


@F.pandas_udf(T.DoubleType())
def st_area(g: pd.Series) -> pd.Series:
    return _each(planar.area, g)


@F.pandas_udf(T.DoubleType())
def st_length(g: pd.Series) -> pd.Series:
    return _each(lambda v: sum(planar.length(c) for k, c in codec.parts(v) if k == "LineString"), g)


@F.pandas_udf(T.BooleanType())
def st_isvalid(g: pd.Series) -> pd.Series:
    return _each(planar.is_valid, g)


@F.pandas_udf(T.StringType())
def st_kind(g: pd.Series) -> pd.Series:
    return _each(lambda v: v[0], g)


@F.pandas_udf(T.LongType())
def st_npoints(g: pd.Series) -> pd.Series:
    count = lambda k, c: 1 if k == "Point" else len(c) if k == "LineString" else sum(map(len, c))
    return _each(lambda v: sum(count(k, c) for k, c in codec.parts(v)), g)


@F.pandas_udf(T.BinaryType())
def st_buffer(g: pd.Series, width: pd.Series) -> pd.Series:
    return _each(_buffer, g, width)


def _mended(g: pd.Series) -> pd.Series:
    def one(data: bytes | None) -> bytes | None:
        v = _parsed(data)
        return data if v is None or v[0] not in ("Polygon", "MultiPolygon") or planar.is_valid(v) else _buffer(v, 0)

    return pd.Series([one(x) for x in g], dtype=object)


#: Invalid polygons rebuilt, null if nothing is left of them; all else as it is. Called non-deterministic, so that a condition on
#: the result is not moved before it, which would build every polygon twice.
mended = F.pandas_udf(_mended, T.BinaryType()).asNondeterministic()


@F.pandas_udf(T.BinaryType())
def st_simplify(g: pd.Series, tolerance: pd.Series) -> pd.Series:
    return _each(lambda v, t: codec.to_wkb(planar.simplified(v, t)), g, tolerance)


@F.pandas_udf(T.BinaryType())
def st_transform(g: pd.Series, source: pd.Series, target: pd.Series) -> pd.Series:
    return _each(_transform, g, source, target)


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def st_parts(g: pd.Series) -> pd.Series:
    """The simple geometries of each geometry."""
    return _each(lambda v: [codec.to_wkb(p) for p in codec.parts(v)], g)


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def st_of_kind(g: pd.Series, kind: pd.Series) -> pd.Series:
    """The geometry itself or its parts that a table of this kind takes."""
    return _each(lambda v, k: [codec.to_wkb(p) for p in planar.of_type(v, k)], g, kind)


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("minx", "miny", "maxx", "maxy")]))
def st_bounds(g: pd.Series) -> pd.DataFrame:
    found = [planar.bounds(_parsed(x)) or (None,) * 4 for x in g]
    return pd.DataFrame(found, columns=["minx", "miny", "maxx", "maxy"], dtype=float)


SQL_NAMES = {
    "ST_Area": st_area, "ST_IsValid": st_isvalid, "ST_Buffer": st_buffer, "ST_AsText": as_text, "ST_GeomFromText": from_text,
    "ST_SimplifyPreserveTopology": st_simplify, "ST_Transform": st_transform, "ST_GeometryType": st_kind, "ST_NPoints": st_npoints,
    "ST_Length": st_length, "ST_Point": point,
}


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL, so that ``where`` strings of declared tables can use them."""
    for name, f in SQL_NAMES.items():
        spark.udf.register(name, f)


def z_cell(bounds: Column, bits: int = 12) -> Column:
    """Interleaved grid bits of a bounding box's centre in degrees: rows that sort together lie together."""
    x = ((bounds["minx"] + bounds["maxx"]) / 2 + 180) / 360
    y = ((bounds["miny"] + bounds["maxy"]) / 2 + 90) / 180
    cells = [F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(v * (1 << bits)).cast("int"))) for v in (x, y)]
    out = F.lit(0)
    for i in range(bits):
        for k, c in enumerate(cells):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), 2 * i + k))
    return out
