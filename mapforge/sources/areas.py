"""Limit areas from files: lines of WKT, GeoJSON, or shapefiles. They are small and read by the driver."""

from __future__ import annotations

import json
import struct

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..geometry import codec, planar


def is_wkt(head: str) -> bool:
    return head.lstrip("﻿ \t\r\n").lower().startswith(("polygon", "multipolygon"))


def polygons_of_text(text: str) -> list[planar.Polygon]:
    """The polygons of lines of WKT; blank lines, and geometries that are none, are skipped."""
    found = []
    for line in text.lstrip("﻿").splitlines():
        if line.strip():
            found += planar.polygons(codec.from_wkt(line))
    return found


def polygons_of_geojson(text: str, where=None) -> list[planar.Polygon]:
    """The polygons of a geometry, feature or collection; ``where`` is a test of a feature's properties."""
    found: list[planar.Polygon] = []

    def walk(o: dict) -> None:
        kind = o.get("type")
        if kind == "FeatureCollection":
            for f in o["features"]:
                walk(f)
        elif kind == "Feature":
            if (where is None or where(o.get("properties") or {})) and o.get("geometry"):
                walk(o["geometry"])
        elif kind == "GeometryCollection":
            for g in o["geometries"]:
                walk(g)
        elif kind in ("Polygon", "MultiPolygon"):
            for rings in [o["coordinates"]] if kind == "Polygon" else o["coordinates"]:
                found.append([[(float(p[0]), float(p[1])) for p in r] for r in rings])

    walk(json.loads(text.lstrip("﻿")))
    return found


def polygons_of_shapefile(data: bytes, keep: set[int] | None = None) -> list[planar.Polygon]:
    """The polygons of a .shp file (of the records numbered in keep): its rings are filled by their winding, so holes need no pairing."""
    if len(data) < 100 or struct.unpack(">i", data[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    at, found, number = 100, [], -1
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        at += 8
        number += 1
        if struct.unpack_from("<i", data, at)[0] in (5, 15, 25) and (keep is None or number in keep):
            n_parts, n_points = struct.unpack_from("<2i", data, at + 36)
            starts = [*struct.unpack_from(f"<{n_parts}i", data, at + 44), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", data, at + 44 + 4 * n_parts)
            points = list(zip(flat[::2], flat[1::2], strict=True))
            rings = [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
            # Clockwise rings are shells, the others holes.
            found += planar.overlay([[(r, 1 if planar.signed_area(r) < 0 else -1) for r in rings]], lambda w: w[0] > 0)
        at += 2 * words
    return found


def attributes_of_dbf(data: bytes) -> tuple[list[tuple[str, str]], list[tuple]]:
    """((name, SQL type) of the columns, rows) of the dBase table beside a shapefile; blank numbers and truth values are null."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    columns, at = [], 32
    while data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("latin-1")
        kind, length, decimals = chr(data[at + 11]), data[at + 16], data[at + 17]
        columns.append((name, "boolean" if kind == "L" else "string" if kind not in "NF" else "double" if decimals or kind == "F" else "bigint", length))
        at += 32

    def value(raw: bytes, kind: str) -> object:
        text = raw.decode("utf-8", "replace").strip("\0 ")
        if kind == "string":
            return text
        if kind == "boolean":
            return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
        return (float(text) if kind == "double" else int(float(text))) if text.strip("*") else None

    rows = []
    for i in range(n):
        begin, row = head + i * size + 1, []
        for _, kind, length in columns:
            row.append(value(data[begin : begin + length], kind))
            begin += length
        rows.append(tuple(row))
    return [(name, kind) for name, kind, _ in columns], rows


def _chosen(spark: SparkSession, rows: list[tuple], schema: str, where: str, name: str) -> set[int]:
    """The fid of the features that a predicate holds for, or that a whole SELECT over the table ``name`` returns (with its fid)."""
    table = spark.createDataFrame(rows, schema)
    if not where.lstrip().lower().startswith("select"):
        return {r["fid"] for r in table.where(where).select("fid").collect()}
    table.createOrReplaceTempView(name)
    try:
        return {r["fid"] for r in spark.sql(where).select("fid").collect()}
    finally:
        spark.catalog.dropTempView(name)


def load_area(spark: SparkSession, path: str, where: str | None = None) -> codec.Geometry:
    """All polygons of a file as one geometry.

    ``where`` is a SQL predicate on the properties of GeoJSON features or the columns of a shapefile's .dbf, or a whole
    SELECT from a table of the file's name that returns the column fid (as SELECT * does).
    """

    def content(path: str) -> bytes:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])

    data, name = content(path), path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    if path.lower().endswith(".shp"):
        keep = None
        if where:
            columns, rows = attributes_of_dbf(content(path[:-3] + ("DBF" if path.endswith("SHP") else "dbf")))
            schema = ", ".join(["fid int", *(f"`{n}` {kind}" for n, kind in columns)])
            keep = _chosen(spark, [(i, *r) for i, r in enumerate(rows)], schema, where, name)
        found = polygons_of_shapefile(data, keep)
    else:
        text = data.decode("utf-8-sig")
        if is_wkt(text[:50]):
            found = polygons_of_text(text)
        elif where:
            features = json.loads(text)["features"]
            names = sorted({k for f in features for k in (f.get("properties") or {})})
            shown = lambda v: v if v is None or isinstance(v, str) else json.dumps(v)
            rows = [(i, *(shown((f.get("properties") or {}).get(n)) for n in names)) for i, f in enumerate(features)]
            keep = _chosen(spark, rows, ", ".join(["fid int", *(f"`{n}` string" for n in names)]), where, name)
            found = polygons_of_geojson(json.dumps({"type": "FeatureCollection", "features": [f for i, f in enumerate(features) if i in keep]}))
        else:
            found = polygons_of_geojson(text)
    if not found:
        raise ValueError(f"{path} has no polygon")
    return ("MultiPolygon", found)
