"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is its set of distinct shingles of ``k`` words (hashed to 64 bits). All sets are ordered by
one global order, rare shingles first. If two sets are as alike as asked, then for any l their prefixes
of |x| - least overlap + l shingles share at least l. Each document picks its own l: a longer prefix costs
more index entries, and asks for more shared ones before a pair is verified; the cost is estimated from
the shingles' frequencies. A pair is verified if it shares as many prefix shingles as the smaller l of
the two, by the exact intersection of whole sets.

Frequencies come from a count sketch of 2^24 cells over all shingles of all documents (16 MB, whatever
the input). They steer costs only: any order and any l gives the same links. But where a cell has many shingles
by chance, frequent ones pass for rare, lists grow long and candidates many: 2^20 cells were too few for 5 GB.

Only components are asked for, so documents of equal sets are one node. Each list of a shingle compares
its least node to all others first; lists are looked at again only where the others make up more than one
component by then, so a group of thousands of near copies costs in proportion to its size. What is left of
long lists (near copies that are not near enough) is compared in blocks that yield links to one root, never
pairs; what is left of short lists is compared pair by pair. The second round's links are contracted onto the
first round's components. No candidate is dropped.

Defined results: a null text or one without words has an empty set and links with nothing; fewer than
``k`` words are one shingle; rows with one doc_id and unequal texts are told apart (by a 64-bit hash of the
text) and each has the place of its own text, so two components may show one id; a row with a null doc_id takes part, and a component's id is its smallest non-null
one; very long texts are hashed in pieces; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import connected_components, dropped, free_shuffles, lookup, maybe_among, measured, temporary, whole_texts, written
from .textkit import BITS, Words, bitmap, is_set, mix, runs, slices

if TYPE_CHECKING:
    import pandas as pd

CELL_BITS, CHUNK_BITS = 24, 14
_MOST_L = 6
#: Lists with more entries are compared in blocks of about BLOCK a side, shorter ones pair by pair.
LONG, BLOCK = 64, 512


def _shingles(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, with repeats."""
    words = Words(texts, lower=True)
    hashes = words.hashes()
    all_runs = runs(hashes, k)
    for i in range(len(texts)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if b - a >= k:
            yield all_runs[a : b - k + 1]
        elif b > a:
            yield runs(hashes[a:b], b - a)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _named(found: np.ndarray) -> int:
    """64 bits that stand for a set (its hashes ascending)."""
    h = mix(np.array([mix(found).sum(dtype=np.uint64) ^ np.uint64(len(found)), np.bitwise_xor.reduce(mix(found + np.uint64(0x51ED27)), initial=np.uint64(0))], dtype=np.uint64))
    name = (int(h[0]) * 31 + int(h[1])) & ((1 << 64) - 1)
    return name - (1 << 64) if name >> 63 else name


def sketch(documents: DataFrame, k: int) -> np.ndarray:
    """How often the shingles of each cell (the upper bits of their hash) occur, above what a cell has by chance: 4 * log2 of it, a byte each.

    Tasks' counts are added chunk by chunk. The median of a chunk's cells stands for chance: most shingles are rare.
    """
    n_chunks, width = 1 << (CELL_BITS - CHUNK_BITS), 1 << CHUNK_BITS
    kind = "chunk int, cells binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = np.zeros(1 << CELL_BITS, dtype=np.uint32), 0
        for piece in slices(batches, "text"):
            for found in _shingles(piece.column(0), k):
                if total + len(found) >= 1 << 32:
                    yield from chunks(cells)
                    cells, total = np.zeros(1 << CELL_BITS, dtype=np.uint32), 0
                np.add.at(cells, (found >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.uint32(1))
                total += len(found)
        if total:
            yield from chunks(cells)

    def chunks(cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts by their bytes, lowest first, as many as the largest needs; packed, as most are 0."""
        for at in range(0, n_chunks, 64):
            rows = []
            for c, row in enumerate(cells.reshape(n_chunks, width)[at : at + 64], at):
                if most := int(row.max()):
                    rows.append((c, zlib.compress(row.astype("<u4").view(np.uint8).reshape(width, 4)[:, : (most.bit_length() + 7) // 8].T.tobytes(), 1)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], type=pa.int32()), pa.array([b for _, b in rows], type=pa.binary())], names=["chunk", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = sums.setdefault(c, np.zeros(width, dtype=np.int64))
                for i, part in enumerate(np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(-1, width)):
                    row += part.astype(np.int64) << (8 * i)
        if sums:
            logs = [np.round(4 * np.log2(np.maximum(row - np.median(row), 1))).astype(np.uint8).tobytes() for row in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.int32()), pa.array(logs, type=pa.binary())], names=["chunk", "cells"])

    parts = documents.select("text").mapInArrow(count, kind).repartition("chunk").mapInArrow(add, kind)
    out = np.zeros((n_chunks, width), dtype=np.uint8)
    for r in parts.collect():  # n_chunks rows
        out[r["chunk"]] = np.frombuffer(r["cells"], dtype=np.uint8)
    return out.ravel()


def _least(n, percent: int):
    """ceil(percent * n / 100): the least overlap of a set of n with any set as alike as asked."""
    return -(-n * percent // 100)


def heads(documents: DataFrame, k: int, percent: int, cells: np.ndarray) -> tuple[DataFrame, int]:
    """(doc_id, text_hash, n, node, l, prefix) of every document, as a table, and how many they are."""
    shared = documents.sparkSession.sparkContext.broadcast(cells)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("l", pa.int32()), ("prefix", pa.list_(pa.int64()))])

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for piece in slices(batches, "text"):
            rows = []
            for doc_id, text_hash, found in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), _shingles(piece.column(0), k), strict=True):
                found = np.unique(found)
                n = len(found)
                if not n:
                    rows.append((doc_id, text_hash, 0, None, None, None))
                    continue
                logs = counts[(found >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                often = np.exp2(logs / 4)
                order = np.lexsort((found, logs // 4))
                least = int(_least(n, percent))
                base = n - least
                upto = np.cumsum(often[order[: base + min(_MOST_L, least)]])
                # Index entries met by a prefix of base + l, and verifications (n per pair) of what is met l times.
                cost = [upto[base + i - 1] * (1 + 0.02 * n / i**2) for i in range(1, min(_MOST_L, least) + 1)]
                l_best = int(np.argmin(cost)) + 1
                rows.append((doc_id, text_hash, n, _named(found), l_best, found[order[: base + l_best]].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    found = documents.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    out, seen = measured(found.mapInArrow(head, "doc_id long, text_hash long, n long, node long, l int, prefix array<long>"), "jaccard-heads")
    shared.destroy()
    return out, seen["n"]


def _sets(documents: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, set) of the nodes wanted (node, text_hash), as a table. Texts are chosen by a bitmap of fixed size.

    The bitmap only spares work: without it every set would be made. Of a text's copies a task makes one set.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.pmod("text_hash", F.lit(BITS)).alias("cell"))))
    schema = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int64()))])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[int] = set()

        def chosen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(1).to_numpy()
                rows = [i for i in np.flatnonzero(is_set(shared.value, hashes)).tolist() if not (hashes[i] in made or made.add(hashes[i]))]
                yield batch.take(pa.array(rows, type=pa.int64()))

        for piece in slices(chosen(), "text"):
            sets = [np.unique(s) for s in _shingles(piece.column(0), k)]
            kept = [s for s in sets if len(s)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([_named(s) for s in kept], type=pa.int64()), pa.array([s.astype(np.int64) for s in kept], type=schema.field(1).type)], schema=schema)

    found = documents.select("text", F.xxhash64("text").alias("text_hash")).mapInArrow(make, "node long, set array<long>")
    out = written(found.join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "jaccard-sets")
    shared.destroy()
    return out


def _stars(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the two blocks of a task (or within its one) as (node, root of its component there)."""
    pdf = pdf.sort_values("node", ignore_index=True)
    lo, hi = int(pdf["lo"][0]), int(pdf["hi"][0])
    block, ids, found = pdf["b"].to_numpy(), pdf["node"].to_numpy(), pdf["set"].tolist()
    a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    sizes = np.array([len(x) for x in found])
    row = np.repeat(np.arange(len(ids)), sizes)
    tokens = np.concatenate(found) if len(found) else np.zeros(0, dtype=np.int64)
    _, token, often = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = often[token] > 1
    row, token = row[shared], np.unique(token[shared], return_inverse=True)[1]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    common = np.zeros((len(a), len(b)), dtype=np.float32)
    width = 4096
    for at in range(0, int(token[-1]) + 1 if len(token) else 0, width):  # the sets as 0/1 columns, some at a time
        i, j = np.searchsorted(token, [at, at + width])
        there = np.zeros((len(ids), width), dtype=np.float32)
        there[row[i:j], token[i:j] - at] = 1
        common += there[a] @ there[b].T
    common = common.astype(np.int64)
    near = 100 * common >= percent * (sizes[a][:, None] + sizes[b][None, :] - common)
    root = np.arange(len(ids))
    while len(a) and len(b):
        new = root.copy()
        np.minimum.at(new, a, np.where(near, root[b][None, :], len(ids)).min(axis=1))
        np.minimum.at(new, b, np.where(near, root[a][:, None], len(ids)).min(axis=0))
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = np.flatnonzero(root != np.arange(len(ids)))
    import pandas as pd

    return pd.DataFrame({"a": ids[linked], "b": ids[root[linked]]})


def components(documents: DataFrame, *, k: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, text_hash, n, node, component_id, part) of (doc_id, text): linked if 100 * intersection >= percent * union.

    part tells components apart, which component_id does not: ids may be null or have several texts. Empty sets have none.
    """
    whole_texts(documents.sparkSession)
    docs = documents.select("doc_id", "text")
    with temporary(documents.sparkSession):
        head, total = heads(docs, k, percent, sketch(docs, k))
        # All copies of a text share their node, so from here on a group of copies is one row.
        one = F.first(F.struct("n", "l", "prefix", "text_hash")).alias("one")
        nodes = head.where("n > 0").groupBy("node").agg(one, F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("count"))
        nodes, seen = measured(nodes.select("node", "one.*", "first", "count"), "jaccard-nodes")
        placed = written(head.select("doc_id", "text_hash", "n", "node"), "jaccard-placed", keep=True)
        dropped(head)
        free_shuffles(documents.sparkSession)
        named = _linked(docs, nodes, seen["n"], k, percent)
    out = lookup(placed, named, "node", "count", total)
    return out.select("doc_id", "text_hash", "n", "node", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "part")


def _linked(docs: DataFrame, nodes: DataFrame, n_nodes: int, k: int, percent: int) -> DataFrame:
    """(node, count, component_id, part) of every node of nodes (node, n, l, prefix, text_hash, first, count), a kept table."""
    entries = nodes.select("node", "n", F.explode("prefix").alias("shingle"))
    lists = entries.groupBy("shingle").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("m")).where("m > 1")
    lists, seen = measured(lists, "jaccard-shingles", F.sum("m").alias("entries"))
    free_shuffles(docs.sparkSession)
    # Most shingles are in one set alone; their entries need not be shuffled again.
    entries = maybe_among(entries, lists, "shingle", "shared").where("shared").drop("shared")
    entries = lookup(entries, lists.withColumn("rows", F.col("m")), "shingle", "rows", seen["entries"] or 0).where("rep IS NOT NULL")
    entries = written(entries, "jaccard-lists")
    dropped(lists)
    free_shuffles(docs.sparkSession)

    def alike(a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent  # no pair of other sizes can be alike enough

    def candidates(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that share prefix shingles enough, with hashes of their texts, as a table."""
        sides = [nodes.select(F.col("node").alias(x), F.col("l").alias(f"l_{x}"), F.col("prefix").alias(f"p_{x}"), F.col("text_hash").alias(f"t_{x}")) for x in ("a", "b")]
        # Sizes first, which are small beside prefixes.
        sizes = [nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b")]
        pairs = pairs.distinct().join(sizes[0], "a").join(sizes[1], "b").where(alike(F.col("n_a"), F.col("n_b"))).select("a", "b")
        met = pairs.join(sides[1], "b").join(sides[0], "a").where(F.size(F.array_intersect("p_a", "p_b")) >= F.least("l_a", "l_b"))
        return written(met.select("a", "b", "t_a", "t_b"), "jaccard-candidates")

    def ends(met: DataFrame) -> DataFrame:
        return met.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("t_a").alias("text_hash")), F.struct(F.col("b").alias("node"), F.col("t_b").alias("text_hash")))))

    def links(met: DataFrame, sets: DataFrame) -> DataFrame:
        """The candidates whose whole sets are alike enough."""
        left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
        common = F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common")
        both = met.select("a", "b").join(right, "b").join(left, "a").select("a", "b", common, (F.size("set_a") + F.size("set_b")).cast("long").alias("sum"))
        return both.where(F.col("common") * 100 >= (F.col("sum") - F.col("common")) * percent).select("a", "b")

    def with_part(df: DataFrame, parts: DataFrame, node: str, name: str) -> DataFrame:
        p = parts.select(F.col("node").alias("__p"), F.col("component").alias("__c"))
        return df.join(p, F.col(node) == F.col("__p"), "left").withColumn(name, F.coalesce("__c", node)).drop("__p", "__c")

    def in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
        """The links among members (shingle, m, node) of each list, compared in blocks that give stars, never pairs."""
        dealt = members.withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")).withColumn("b", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tasks = dealt.select("node", "shingle", "b", F.least("b", "other").alias("lo"), F.greatest("b", "other").alias("hi")).join(sets, "node")
        return tasks.groupBy("shingle", "lo", "hi").applyInPandas(lambda pdf: _stars(pdf, percent), "a long, b long")

    # 1. In each list its least node against all others.
    others = entries.where("node != rep")
    met = candidates(others.select(F.col("rep").alias("a"), F.col("node").alias("b")))
    free_shuffles(docs.sparkSession)
    sets = _sets(docs, ends(met), k)
    free_shuffles(docs.sparkSession)
    parts = connected_components(links(met, sets), "a", "b")
    free_shuffles(docs.sparkSession)
    # 2. Lists whose other members still are in several components.
    others = with_part(others.where("m > 2").select("shingle", "node", "n", "m"), parts, "node", "part")
    others, seen = measured(others, "jaccard-others")
    dropped(entries)
    free_shuffles(docs.sparkSession)
    crossing = others.groupBy("shingle").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo < hi").select("shingle", "rows", F.lit(True).alias("open"))
    others, left = measured(lookup(others, crossing, "shingle", "rows", seen["n"]).where("open").drop("open"), "jaccard-open", F.max("m").alias("longest"))
    free_shuffles(docs.sparkSession)
    if left["n"]:
        # Short ones: all pairs across components, at most LONG / 2 an entry.
        rest = others.where(F.col("m") <= LONG)
        x = rest.select("shingle", F.col("node").alias("a"), F.col("n").alias("na"), F.col("part").alias("ca"))
        y = rest.select("shingle", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("part").alias("cb"))
        pairs = x.join(y, "shingle").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & alike(F.col("na"), F.col("nb"))).select("a", "b")
        again = candidates(pairs.distinct().join(met.select("a", "b"), ["a", "b"], "left_anti"))
        free_shuffles(docs.sparkSession)
        wanted, members = ends(again), None
        if left["longest"] > LONG:
            # Long ones, in blocks: those that are some node's longest, and those whose members have several such lists.
            long = others.where(F.col("m") > LONG).select("node", "shingle", "m")
            home = long.groupBy("node").agg(F.max(F.struct("m", "shingle")).alias("home")).select("node", F.col("home.shingle").alias("home"))
            long = written(long.join(home, "node"), "jaccard-long")
            chosen = long.groupBy("shingle").agg(F.min("home").alias("lo"), F.max("home").alias("hi")).where("lo < hi").select("shingle")
            chosen = chosen.unionByName(long.select(F.col("home").alias("shingle"))).distinct()
            members = written(long.join(chosen, "shingle").join(nodes.select("node", "text_hash"), "node").select("shingle", "m", "node", "text_hash"), "jaccard-members")
            wanted = wanted.unionByName(members.select("node", "text_hash"))
        sets = sets.unionByName(_sets(docs, wanted.distinct().join(sets.select("node"), "node", "left_anti"), k))
        free_shuffles(docs.sparkSession)
        found = links(again, sets)
        if members is not None:
            found = found.unionByName(in_blocks(members.drop("text_hash"), sets))
        # Contracted onto the components of the first round: only links that join two of them are left.
        found = with_part(with_part(found, parts, "a", "part_a"), parts, "b", "part_b").where("part_a != part_b").select("part_a", "part_b")
        joined = connected_components(found, "part_a", "part_b")
    named = with_part(nodes.select("node", "first", "count"), parts, "node", "part")
    if left["n"]:
        named = with_part(named, joined, "part", "whole").select("node", "first", "count", F.col("whole").alias("part"))
    named = written(named, "jaccard-parts")
    least = named.groupBy("part").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    out = lookup(named.select("node", "count", "part"), least, "part", "n", n_nodes)
    return written(out.select("node", "count", "component_id", "part"), "jaccard-components", keep=True)


def near_copies(documents: DataFrame, *, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of (doc_id, text)."""
    return components(documents, k=k, percent=percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def deduplicated(documents: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """documents with one row of each component: that of the smallest doc_id (null last), then text hash.

    Rows are told apart by doc_id and text, so an id's other texts stay in their own components, and so do
    null ids. Empty sets stay. Rows equal in a non-null doc_id and text, empty or not, are one document.
    """
    def key(text_hash: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), text_hash.cast("string"))

    with temporary(documents.sparkSession):
        placed = components(documents, k=k, percent=percent)
        keys, seen = measured(placed.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n"), F.min("part").alias("part")), "jaccard-keys", F.sum("rows").alias("rows"))
        total = seen["rows"] or 0
        first = keys.where("n > 0").groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
        first = first.select(F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash"))
        marks = keys.join(first, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
        marks = marks.withColumn("gone", (F.col("n") > 0) & F.col("__hash").isNull()).where("gone OR rows > 1 AND (n > 0 OR doc_id IS NOT NULL)")
        marks = marks.select(key(F.col("text_hash")).alias("key"), "rows", "gone").withColumn("hash", F.xxhash64("key"))
        marks, left = measured(marks, "jaccard-marks", F.count_if(~F.col("gone")).alias("repeated"), keep=True)
    rows = documents.select(F.struct("*").alias("row"), key(F.xxhash64("text")).alias("key")).withColumn("hash", F.xxhash64("key"))
    rows = maybe_among(rows, marks, "hash", "marked").select("row", "key", "marked")
    some = rows.where("marked")  # only these are shuffled

    def parted(of: DataFrame) -> list[DataFrame]:
        """The keys of hot rows (fewer than a thousand, so they are broadcast) and of all others."""
        return [F.broadcast(of.where(F.col("rows") * 1000 > total).select("key")), of.where(F.col("rows") * 1000 <= total).select("key")]

    hot, rest = parted(marks)
    kept = rows.where("NOT marked").select("row").unionByName(some.join(hot, "key", "left_anti").join(rest, "key", "left_anti").select("row"))
    if left["repeated"]:
        hot, rest = parted(marks.where("NOT gone"))
        again = some.join(hot, "key", "left_semi").unionByName(some.join(rest, "key", "left_semi"))
        # min_by adds up before the shuffle, so many equal rows never meet in one task.
        kept = kept.unionByName(again.groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return kept.select("row.*")
