"""Substring dedup by seed and extend.

Seeds: of each ``window`` of words the least hash of its ``seed``-word runs is its anchor (winnowing), so
equal windows have equal anchors at equal places, and one word in a dozen is an anchor. Documents are
joined on anchors that occur again. Extension: an anchor's reach is the words of all windows it anchors,
both ways. Where every occurrence of an anchor has the same reach, all of it repeats at once. Elsewhere
(at the edges of passages) an occurrence is extended window by window, and a window repeats if its words
occur again. Repeats that touch or overlap make up the maximal repeats, all at least a window long, and
their words are removed.

Which windows repeat is judged on the whole input. Work grows with the text: occurrences are never
paired, the counts of anchors and windows are aggregated before the shuffle, and those of very common
ones are looked up apart. A bitmap of fixed size spares the second scan most windows that need no search;
it changes no result. Occurrences of an anchor with one reach between them are alike in all
their windows, so one of them stands for all in that search.

Defined results: a null text has no words; words are compared unchanged; rows equal in doc_id and text
are each other's repeats; very long texts are hashed in pieces; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lookup, measured, temporary, whole_texts, written
from .textkit import BITS, Words, _power, bitmap, is_set, mix, runs, slices

SEED = 8
SPREAD = 2654435761


def _anchored(texts: pa.Array, window: int, seed: int):
    """Per occurrence of an anchor: text, first and last window it anchors, anchor hash, reach hash; and the hash of every window."""
    words = Words(texts)
    hashes = words.hashes()
    grams = runs(hashes, seed)
    each = window - seed + 1  # grams of a window
    n = len(hashes) - window + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), words, np.zeros(0, dtype=np.uint64)
    least, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for o in range(1, each):
        other = grams[o : o + n]
        less = other < least
        np.copyto(least, other, where=less)
        at[less] = o
    at += np.arange(n)
    text = np.searchsorted(words.first, np.arange(n), side="right") - 1
    whole = np.arange(n) + window <= words.first[text + 1]
    p = np.flatnonzero(whole)  # the windows that lie in one text
    if not len(p):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), words, np.zeros(0, dtype=np.uint64)
    new = np.empty(len(p), dtype=bool)
    new[0] = True
    new[1:] = (at[p][1:] != at[p][:-1]) | (text[p][1:] != text[p][:-1])
    i = np.flatnonzero(new)
    first, last = p[i], p[np.append(i[1:], len(p)) - 1]
    up, down = _power(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    length = last + window - first
    reach = mix((sums[first + length] - sums[first]) * down[first] + length.astype(np.uint64) * np.uint64(0x9E3779B1) + (at[first] - first).astype(np.uint64))
    return text[first], first - words.first[text[first]], last - words.first[text[first]], grams[at[first]], reach, words, runs(hashes, window)


def repeated(documents: DataFrame, window: int = 35, seed: int = SEED) -> DataFrame:
    """(k, first, last): ranges of repeated windows of the document with key k = xxhash64(doc_id, text)."""
    with temporary(documents.sparkSession):
        return written(_repeated(documents, window, seed), "repeated", keep=True)


def _repeated(documents: DataFrame, window: int, seed: int) -> DataFrame:
    docs = documents.select("text", F.xxhash64("doc_id", "text").alias("k"))
    i64, i32 = pa.int64(), pa.int32()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            text, first, last, anchor, reach, _, _ = _anchored(piece.column(0), window, seed)
            if len(text):
                keys = piece.column(1).to_numpy()[text]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(first, type=i32), pa.array(last, type=i32), pa.array(anchor.astype(np.int64)), pa.array(reach.astype(np.int64))], names=["k", "first", "last", "anchor", "reach"])

    found = written(docs.mapInArrow(anchors, "k long, first int, last int, anchor long, reach long"), "anchors")
    again = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("lo"), F.max("reach").alias("hi")).where("n > 1")
    again = written(again.select("anchor", "n", (F.col("lo") == F.col("hi")).alias("one")), "anchors-again")
    occurrences = lookup(found, again, "anchor", "n", found.count()).where("one IS NOT NULL")
    occurrences = written(occurrences.select("k", "first", "last", "anchor", "reach", "one"), "occurrences")
    same = occurrences.where("one").select("k", "first", "last")
    mixed = occurrences.where("NOT one")
    by_reach = written(mixed.groupBy(F.xxhash64("anchor", "reach").alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "first")).alias("only")), "reaches")
    many = lookup(mixed.select("k", "first", "last", F.xxhash64("anchor", "reach").alias("r")), by_reach.where("n > 1").select("r", "n", F.lit(True).alias("many")), "r", "n", mixed.count())
    same = same.unionByName(many.where("many").select("k", "first", "last"))
    # One occurrence of each reach stands for all in the search window by window.
    cell = F.col("only.k").bitwiseXOR(F.col("only.first").cast("long") * SPREAD)
    chosen = bitmap(by_reach.select(F.pmod(cell, F.lit(BITS)).alias("cell")))
    shared = documents.sparkSession.sparkContext.broadcast(chosen)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = shared.value
        for piece in slices(batches, "text"):
            text, first, last, _, _, words, hashes = _anchored(piece.column(0), window, seed)
            if not len(text):
                continue
            keys = piece.column(1).to_numpy()
            chosen = np.flatnonzero(is_set(hit, keys[text] ^ (first * SPREAD)))
            if not len(chosen):
                continue
            text, first, last = text[chosen], first[chosen], last[chosen]
            n = last - first + 1
            row = np.repeat(np.arange(len(n)), n)
            at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(keys[text[row]]), pa.array(at, type=i32), pa.array(hashes[at + words.first[text[row]]].astype(np.int64))], names=["k", "first", "window"])

    single, seen = measured(docs.mapInArrow(windows, "k long, first int, window long"), "windows")
    shared.destroy()
    twice = written(single.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("again", F.lit(True)), "windows-again")
    edges = lookup(single, twice, "window", "n", seen["n"]).where("again").select("k", "first", F.col("first").alias("last"))
    return same.unionByName(edges).distinct()


def without_repeats(documents: DataFrame, window: int = 35, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept is the words left, joined by one space, as UTF-8."""
    whole_texts(documents.sparkSession)
    ranges = repeated(documents, window, seed).groupBy("k").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")).withColumnRenamed("k", "__k")
    docs = documents.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("k"))
    docs = docs.join(ranges, F.col("k") == F.col("__k"), "left").select("text", "doc_id", "firsts", "lasts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words = Words(piece.column(0))
            mask, data = words.inside.copy(), words.data.copy()
            after = words.ends[words.ends < len(data)]
            after = after[~words.inside[after]]
            data[after], mask[after] = 32, True  # one space behind each word that has any
            removed = []
            for i, (firsts, lasts) in enumerate(zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)):
                base, n = int(words.first[i]), int(words.first[i + 1] - words.first[i])
                gone = np.zeros(n + 1, dtype=np.int64)
                if firsts:
                    np.add.at(gone, np.array(firsts), 1)
                    np.add.at(gone, np.minimum(np.array(lasts) + window, n), -1)
                gone = np.cumsum(gone[:n]) > 0
                removed.append(int(gone.sum()))
                if removed[-1]:
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    for a, b in zip(edges[::2], edges[1::2], strict=True):  # runs of removed words
                        end = int(words.ends[base + b - 1])
                        mask[int(words.starts[base + a]) : min(end + 1, int(words.offsets[i + 1]))] = False
            kept = [data[a:b][mask[a:b]].tobytes() for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)]
            kept = [x[:-1] if x.endswith(b" ") else x for x in kept]
            n_words = np.diff(words.first)
            yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(n_words, type=i64), pa.array(removed, type=i64), pa.array(kept, type=pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    i64 = pa.int64()
    return docs.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary")
