"""Elements that several extracts hold: ways cut at an extract's border become whole again.

Tags and members are merged by expressions (``elements.merge_tags``, ``merge_members``); sequences of
vertices need an alignment, which an Arrow-batched function does way by way.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged_pair(a: list[int], b: list[int]) -> list[int] | None:
    """Both sequences in one, woven along what they share; None if they share nothing."""
    if not a or not b:
        return None
    blocks = [m for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    if not blocks:
        return None
    out, i, j = [], 0, 0
    for m in blocks:
        out += a[i : m.a] + b[j : m.b] + a[m.a : m.a + m.size]
        i, j = m.a + m.size, m.b + m.size
    return out + a[i:] + b[j:]


def merged(sequences: list[list[int]]) -> list[list[int]]:
    """Sequences merged pair by pair until no two share a vertex: one if all of them hang together."""
    pool = list(sequences)
    while len(pool) > 1:
        for i in range(len(pool)):
            j = next((k for k in range(i + 1, len(pool)) if set(pool[i]) & set(pool[k])), None)
            if j is not None:
                joined = merged_pair(pool[i], pool[j])
                pool = pool[:i] + [joined] + [p for k, p in enumerate(pool[i + 1 :], i + 1) if k != j]
                break
        else:
            break
    return pool


@F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _merged(sequences: pd.Series) -> pd.Series:
    return pd.Series([merged([list(map(int, s)) for s in group]) for group in sequences], dtype=object)


def merge_ways(copies: DataFrame, order: str) -> DataFrame:
    """(osm_id, tags, refs, partial) of ways' copies: the later copy's value of a key counts, sequences are merged.

    Where the copies' sequences do not hang together ``refs`` is the first and ``partial`` true; a
    relation with such a member cannot be built, nor one with a copy that was ``partial`` already. Ways with one copy, or equal copies, pass without Python.
    """
    from .elements import merge_tags

    was = F.col("partial") if "partial" in copies.columns else F.lit(False)
    lines = copies.groupBy("osm_id").agg(F.sort_array(F.collect_list(F.struct(order, "refs"))).alias("c"), F.bool_or(was).alias("was"))
    lines = lines.select("osm_id", "was", F.array_distinct(F.col("c.refs")).alias("s"))
    one = lines.where(F.size("s") == 1).select("osm_id", F.col("s")[0].alias("refs"), F.col("was").alias("partial"))
    more = lines.where(F.size("s") > 1).select("osm_id", "was", _merged("s").alias("m")).select("osm_id", F.col("m")[0].alias("refs"), (F.col("was") | (F.size("m") > 1)).alias("partial"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    tags = merge_tags(copies, order)
    return one.unionByName(more).join(tags, "osm_id", "left").select("osm_id", F.coalesce("tags", none).alias("tags"), "refs", "partial")


def merge_relations(copies: DataFrame, order: str) -> DataFrame:
    """(osm_id, tags, members) of relations' copies: members one after another, the first of each ref."""
    from .elements import merge_members, merge_tags

    rows = copies.groupBy("osm_id").agg(F.sort_array(F.collect_list(F.struct(order, "members"))).alias("c"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    members = rows.select("osm_id", merge_members(F.flatten("c.members")).alias("members"))
    return members.join(merge_tags(copies, order), "osm_id", "left").select("osm_id", F.coalesce("tags", none).alias("tags"), "members")


def merge_points(copies: DataFrame, order: str) -> DataFrame:
    """Nodes or coords once each: those of the latest extract."""
    columns = [c for c in copies.columns if c not in ("osm_id", order)]
    return copies.groupBy("osm_id").agg(F.max_by(F.struct(*columns), order).alias("v")).select("osm_id", "v.*")
