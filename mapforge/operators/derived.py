"""Tables from tables: generalized ones, repaired polygons, and the order to derive them in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..mapping import Generalized


def generalized(origin: DataFrame, tolerance: float, where: str | None = None) -> DataFrame:
    """origin's rows that ``where`` holds for, with simpler geometries. ``where`` may use the registered ST_ functions."""
    geo.register(origin.sparkSession)
    rows = origin.where(where) if where else origin
    return rows.withColumn("geometry", geo.st_simplify("geometry", F.lit(float(tolerance))))


def repaired(table: DataFrame) -> DataFrame:
    """Invalid polygons rebuilt; those of which nothing is left go. Valid rows and other geometries stay as they are."""
    return table.withColumn("geometry", geo.mended("geometry")).where(F.col("geometry").isNotNull())


def in_order(tables: Iterable[Generalized], known: Iterable[str]) -> list[Generalized]:
    """Generalized tables, each behind its origin; ValueError names those whose origin there is none of."""
    waiting, done, out = list(tables), set(known), []
    while waiting:
        ready = [t for t in waiting if t.origin in done]
        if not ready:
            raise ValueError(f"no origin for {sorted(t.name for t in waiting)}")
        out += ready
        done |= {t.name for t in ready}
        waiting = [t for t in waiting if t.name not in done]
    return out
