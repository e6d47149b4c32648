"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors equal in label and all components are one class with a count. Classes are normalised, so that
cosine c is distance sqrt(2 - 2c), and hashed into several tables by quantised random projections. The
members of a bucket are compared exactly, in blocks of at most about ``block`` members a side, so that a
large bucket is many tasks and none gathers it; a task goes through many small buckets at once, those of one
size as one stack. A near pair that meets in several tables counts in the first. A task returns counts per class and a star for each component that it sees, never pairs; so its output
is no larger than its input. Hash widths follow from the number of vectors: see ``tables_for``.

Defined results: vectors that are null, zero, or hold null or non-finite components, and those with a
null label or vec_id, link with nothing; rows of equal vectors link with each other, and so do rows that
share a vec_id (n_links counts rows); vectors of different lengths don't link; very long vectors are
hashed like others; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import connected_components, lookup, measured, written

WIDTH = 0.8  # of a quantisation step, for unit vectors


def collision(distance: float, width: float = WIDTH) -> float:
    """The probability that two points at a distance share one quantised projection."""
    r = width / max(distance, 1e-9)
    cdf = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * cdf - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(n: int, cosine: float, miss: float = 0.01) -> tuple[int, int]:
    """(projections a table, tables): unrelated vectors share a bucket with one other or so; a pair at the threshold is missed with probability ``miss``."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(3, round(math.log(max(n, 2)) / math.log(1 / far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, where each begins) of a list column; the values are column.flatten()."""
    lengths = column.value_lengths().to_numpy().astype(np.int64)
    return lengths, np.cumsum(lengths) - lengths


def _keys(batches: Iterator[pa.RecordBatch], per_table: int, tables: int, seed: int) -> Iterator[pa.RecordBatch]:
    planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        sizes, begin = _lists(batch.column(1))
        values, ids = batch.column(1).flatten().to_numpy().astype(np.float64), batch.column(0).to_numpy()
        for d in np.unique(sizes):
            rows = np.flatnonzero(sizes == d)
            x = _unit(values[begin[rows][:, None] + np.arange(d)])
            if d not in planes:
                rng = np.random.default_rng([seed, int(d)])
                planes[d] = rng.standard_normal((int(d), per_table * tables)), rng.uniform(0, WIDTH, per_table * tables)
            a, b = planes[d]
            cells = np.floor((x @ a + b) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(rows), tables, per_table)
            keys = np.zeros((len(rows), tables), dtype=np.uint64)
            for j in range(per_table):
                keys = (keys ^ cells[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(29)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * tables), pa.array(keys.astype(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), flat], names=["id", "keys"])


def _near(x: np.ndarray, ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of near pairs, each pair once, of groups that end at ends: all rows of a group, or its two blocks."""
    begins = np.concatenate([[0], ends[:-1]])
    sizes, found = ends - begins, []
    whole = lo[begins] == hi[begins]
    for s in np.unique(sizes[whole]):
        if s < 2:
            continue
        chosen = begins[whole & (sizes == s)]
        step = max(1, (1 << 21) // int(s * max(s, x.shape[1])))  # stacks of some 16 MB
        above = np.triu(np.ones((s, s), dtype=bool), 1)
        for at in range(0, len(chosen), step):
            rows = chosen[at : at + step, None] + np.arange(s)
            y = x[rows]
            g, i, j = np.nonzero((y @ y.transpose(0, 2, 1) >= cosine) & above)
            found.append((rows[g, i], rows[g, j]))
    for k in np.flatnonzero(~whole).tolist():
        rows = np.arange(begins[k], ends[k])
        a, b = rows[block[rows] == lo[rows[0]]], rows[block[rows] == hi[rows[0]]]
        if len(a) and len(b):
            i, j = np.nonzero(x[a] @ x[b].T >= cosine)
            found.append((a[i], b[j]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([f[side] for f in found]).astype(np.int64) for side in (0, 1))


def _compare(batches: Iterator[pa.RecordBatch], cosine: float, most: int = 8192) -> Iterator[pa.RecordBatch]:
    """Links within the groups (bucket, lo, hi), whose rows follow each other: per class their number, and the root of its component."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        get = lambda name: rows.column(name).combine_chunks()
        bucket, lo, hi, block, ids, m, table = (get(c).to_numpy() for c in ("bucket", "lo", "hi", "b", "id", "m", "table"))
        new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        ends = np.append(new, len(ids))
        vectors, keys = get("embedding"), get("keys")
        sizes, begin = _lists(vectors)
        values = vectors.flatten().to_numpy().astype(np.float64)
        x = np.zeros((len(ids), int(sizes.max())))
        for d in np.unique(sizes):
            of = np.flatnonzero(sizes == d)
            x[of, :d] = _unit(values[begin[of][:, None] + np.arange(d)])
        tables = _lists(keys)[0][0]
        keys = keys.flatten().to_numpy().reshape(len(ids), tables)
        i, j = _near(x, ends, lo, hi, block, cosine)
        kept = np.ones(len(i), dtype=bool)
        for at in range(0, len(i), 1 << 16):  # only near pairs look at the tables before theirs
            p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            kept[at : at + (1 << 16)] = ~((keys[p] == keys[q]) & (np.arange(tables) < table[p][:, None])).any(axis=1)
        i, j = i[kept], j[kept]
        count = np.zeros(len(ids), dtype=np.int64)
        np.add.at(count, i, m[j])
        np.add.at(count, j, m[i])
        root = np.arange(len(ids))
        while True:
            least = np.minimum(root[i], root[j])
            after = root.copy()
            for side in (i, j, root[i], root[j]):
                np.minimum.at(after, side, least)
            after = after[after]
            if (after == root).all():
                break
            root = after
        keep = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(count[keep]), pa.array(ids[root[keep]])], names=["id", "links", "root"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            rows = pa.Table.from_batches(held)
            bucket, lo, hi = (rows.column(c).to_numpy() for c in ("bucket", "lo", "hi"))
            new = np.flatnonzero((bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
            if len(new):  # the last group may go on in the next batch
                cut = int(new[-1]) + 1
                yield links(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
    if held and sum(b.num_rows for b in held):
        yield links(pa.Table.from_batches(held))


def near_duplicates(embeddings: DataFrame, *, cosine: float = 0.98, block: int = 1024, miss: float = 0.01, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept of (vec_id, embedding, label)."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", valid.alias("valid"))
    # A key of 128 bits stands for label and components.
    key = F.when(F.col("valid"), F.concat_ws(":", F.xxhash64(F.lit(1), "label", "embedding").cast("string"), F.xxhash64("embedding", F.lit(2), "label").cast("string")))
    rows = rows.withColumn("k", key)
    classes = rows.where("valid").groupBy("k").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = written(classes, "vector-classes").withColumn("uid", F.xxhash64("k"))
    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    per_table, tables = tables_for(most, cosine, miss)
    keyed = classes.select("uid", "embedding").mapInArrow(lambda b: _keys(b, per_table, tables, seed), "id long, keys array<long>")
    keyed, seen = measured(keyed.withColumnRenamed("id", "uid"), "vector-keys")
    base = classes.join(keyed, "uid").select("uid", "label", "m", "embedding", "keys")
    members = base.select("uid", F.posexplode("keys").alias("table", "key"), "label", F.size("embedding").alias("d"))
    members = members.select("uid", "table", F.xxhash64("table", "key", "label", "d").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    total = seen["n"] * tables
    shared = lookup(members, written(sizes, "vector-buckets"), "bucket", "n", total or 1).where("blocks IS NOT NULL")
    shared = shared.withColumn("b", F.pmod(F.xxhash64("uid", F.lit(3)), F.col("blocks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = shared.select("uid", "table", "bucket", "b", F.least("b", "other").alias("lo"), F.greatest("b", "other").alias("hi"))
    tasks = tasks.join(base.select("uid", "m", "embedding", "keys"), "uid").withColumnRenamed("uid", "id")
    dealt = tasks.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    found = dealt.select("id", "table", "bucket", "b", "lo", "hi", "m", "embedding", "keys").mapInArrow(lambda b: _compare(b, cosine), "id long, links long, root long")
    found = written(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "uid")
    part = connected_components(found, "id", "root").withColumnRenamed("node", "uid")
    named = classes.select("uid", "k", "id", "m").join(links, "uid", "left").join(part, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component").select("k", F.col("m").alias("n"), (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = lookup(rows.select("vec_id", "k"), written(named, "vector-components"), "k", "n", embeddings.count())
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
