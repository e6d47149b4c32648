"""Words of whole Arrow string columns as numpy arrays, without a Python loop over words.

A word is a maximal run of bytes outside space and 0x09-0x0D; all of these are single bytes in
UTF-8, so splitting bytes splits code points rightly. Runs on executors inside mapInArrow.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmaps that spare work on rows that cannot matter (4 MB, whatever the input).
BITS = 1 << 25
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_SEGMENT = 1 << 20
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i in 0..n."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n, _SEGMENT) + 1
        for name, r in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, r, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


class Words:
    """The words of some texts: where each starts and ends in ``data``, its hash, and the first word of each text."""

    def __init__(self, texts: pa.Array, lower: bool = False) -> None:
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        self.inside = inside = ~_SPACE[self.data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.empty(len(data), dtype=bool)
        before[:1] = False
        before[1:] = inside[:-1]
        after = np.empty(len(data), dtype=bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.first[-1] = len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial over its bytes, finalised with its length."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(self.starts):
            begin = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, begin + _SEGMENT, side="right")))
            s, e = self.starts[i:j] - begin, self.ends[i:j] - begin
            up, down = _power(int(e[-1]))
            sums = np.zeros(int(e[-1]) + 1, dtype=np.uint64)
            np.cumsum((self.data[begin : begin + int(e[-1])].astype(np.uint64) + np.uint64(1)) * up[: int(e[-1])], out=sums[1:])
            out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            i = j
        return mix(out)


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k consecutive words, by the index of the first; the caller drops those across texts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[:n] + np.uint64(k))


def release() -> None:
    """Give freed memory back to the system: Python workers stay alive between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of some ``most`` bytes of text, so that the arrays built from one stay small; a longer text comes alone."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        if not len(text):
            continue
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64, count=len(text) + 1 + text.offset)[text.offset :]
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
    release()


def bitmap(cells: DataFrame) -> np.ndarray:
    """BITS bits, packed in bytes: those of the numbers (cell) are set. Rows are merged to 8192 byte strings before they reach the driver."""
    width = 4096

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            found = np.unique(batch.column(0).to_numpy())
            for r, at in zip(*np.unique(found // width, return_index=True), strict=True):
                rows.setdefault(int(r), np.zeros(width, dtype=bool))
                end = np.searchsorted(found, (r + 1) * width)
                rows[int(r)][found[at:end] - r * width] = True
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), type=pa.int32()), pa.array([np.packbits(v).tobytes() for v in rows.values()], type=pa.binary())], names=["row", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = np.frombuffer(bits, dtype=np.uint8)
                rows[r] = rows[r] | v if r in rows else v
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), type=pa.int32()), pa.array([v.tobytes() for v in rows.values()], type=pa.binary())], names=["row", "bits"])

    out = np.zeros(BITS // 8, dtype=np.uint8)
    kind = "row int, bits binary"
    for r in cells.select(F.col("cell").cast("int")).mapInArrow(add, kind).repartition("row").mapInArrow(merge, kind).collect():
        out[r["row"] * width // 8 : (r["row"] + 1) * width // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def is_set(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which of the numbers (modulo BITS) are in a bitmap."""
    at = numbers & (BITS - 1)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
