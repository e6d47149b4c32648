"""OpenStreetMap PBF as a Spark data source: ``spark.read.format("osm_pbf").option("kind", "ways").load(path)``.

The driver reads the blobs' headers only; each partition reads and inflates a run of blobs. Paths must be
readable by Python on driver and executors (local or mounted); others go through ``read_pbf_files``.
"""

from __future__ import annotations

import glob
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .xml import Elements

SCHEMAS = {
    "coords": "osm_id bigint, lon double, lat double",
    "nodes": "osm_id bigint, tags map<string,string>, lon double, lat double",
    "ways": "osm_id bigint, tags map<string,string>, refs array<bigint>",
    "relations": "osm_id bigint, tags map<string,string>, members array<struct<ref:bigint,type:string,role:string>>",
}
_TAGS = pa.map_(pa.string(), pa.string())
_MEMBER = pa.struct([("ref", pa.int64()), ("type", pa.string()), ("role", pa.string())])
_TYPES = {"osm_id": pa.int64(), "lon": pa.float64(), "lat": pa.float64(), "tags": _TAGS, "refs": pa.list_(pa.int64()), "members": pa.list_(_MEMBER)}
#: The columns of each kind as Arrow holds them.
ARROW = {kind: pa.schema([(c.split()[0], _TYPES[c.split()[0]]) for c in text.split(", ")]) for kind, text in SCHEMAS.items()}
#: The format's own numbers of member types.
MEMBER_TYPES = ("node", "way", "relation")
#: Features of a file that a reader has to know to read it.
UNDERSTOOD = {"OsmSchema-V0.6", "DenseNodes"}
PARTITION_BYTES = 32 << 20


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: ints, or the bytes of strings, messages and packed lists."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = varint(data, at)
        elif wire == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire} is not part of the format")
        yield key >> 3, value


def packed(data: bytes, signed: bool = False) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = varint(data, at)
        out.append((v >> 1) ^ -(v & 1) if signed else v - (1 << 64) if v >> 63 else v)
    return out


def numbers(data: bytes, signed: bool = False) -> np.ndarray:
    """packed() for long lists, all at once."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(raw < 0x80)
    if not len(ends) or ends[-1] != len(raw) - 1:
        raise ValueError("a list ends within a number")
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    v = np.add.reduceat((raw & 0x7F).astype(np.uint64) << (7 * np.minimum(place, 9)).astype(np.uint64), starts)
    return (v >> np.uint64(1)).astype(np.int64) ^ -(v & np.uint64(1)).astype(np.int64) if signed else v.astype(np.int64)


def _running(deltas: list[int]) -> list[int]:
    total, out = 0, []
    for d in deltas:
        total += d
        out.append(total)
    return out


def _signed(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def blobs(path: str) -> Iterator[tuple[str, int, int]]:
    """(type, offset, size) of every blob of a file."""
    end = os.path.getsize(path)
    with open(path, "rb") as f:
        while f.tell() < end:
            head = f.read(4)
            if len(head) < 4:
                raise ValueError(f"{path} ends within a header")
            found = dict(fields(f.read(struct.unpack(">I", head)[0])))
            offset = f.tell()
            if offset + found[3] > end:
                raise ValueError(f"{path} ends within a blob")
            yield found[1].decode(), offset, found[3]
            f.seek(offset + found[3])


def inflated(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    if 7 in found:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(found[7], max_output_size=found[2])
    if 4 in found:
        import lzma

        return lzma.decompress(found[4])
    raise ValueError("a blob in an unknown compression")


def check_header(block: bytes) -> None:
    needed = {v.decode() for n, v in fields(block) if n == 4}
    if needed - UNDERSTOOD:
        raise ValueError(f"the file needs {sorted(needed - UNDERSTOOD)}")


def batches_of(block: bytes, kind: str) -> Iterator[pa.RecordBatch]:
    """The elements of one kind in a block, a batch for each of its groups that has some."""
    strings: list[str] = []
    groups, grain, lat0, lon0 = [], 100, 0, 0
    for n, v in fields(block):
        if n == 1:
            strings = [s.decode("utf-8", "replace") for _, s in fields(v)]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            grain = v
        elif n == 19:
            lat0 = v - (1 << 64) if v >> 63 else v
        elif n == 20:
            lon0 = v - (1 << 64) if v >> 63 else v

    def tagged(found: dict[int, list]) -> list[tuple[str, str]]:
        keys, values = (packed(b"".join(found.get(n, []))) for n in (2, 3))
        return list({strings[k]: strings[v] for k, v in zip(keys, values, strict=True)}.items())

    def points(ids: np.ndarray, lons: np.ndarray, lats: np.ndarray, tags: list[list] | None) -> Iterator[pa.RecordBatch]:
        x, y = (lon0 + grain * lons) / 1e9, (lat0 + grain * lats) / 1e9
        if kind == "coords":
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(x), pa.array(y)], schema=ARROW[kind])
        elif some := [i for i, t in enumerate(tags) if t]:
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array([tags[i] for i in some], type=_TAGS), pa.array(x[some]), pa.array(y[some])], schema=ARROW[kind])

    def dense_tags(data: bytes, n: int) -> list[list]:
        """Keys and values in turn, with a 0 after each node's last; no list at all where no node has tags."""
        flat = iter(packed(data))
        out = []
        for _ in range(n if data else 0):
            tags = {}
            while k := next(flat, 0):
                tags[strings[k]] = strings[next(flat)]
            out.append(list(tags.items()))
        return out

    for group in groups:
        single, rows = [], []
        for n, v in fields(group):
            if n == 1 and kind in ("coords", "nodes"):
                found = _listed(v)
                single.append((_signed(found[1][0]), _signed(found[9][0]), _signed(found[8][0]), tagged(found) if kind == "nodes" else []))
            elif n == 2 and kind in ("coords", "nodes"):
                found = _listed(v)
                ids, lats, lons = (np.cumsum(numbers(b"".join(found.get(i, [])), signed=True)) for i in (1, 8, 9))
                if not len(ids) == len(lats) == len(lons):
                    raise ValueError("nodes without a place")
                if len(ids):
                    yield from points(ids, lons, lats, dense_tags(b"".join(found.get(10, [])), len(ids)) if kind == "nodes" else None)
            elif n == 3 and kind == "ways":
                found = _listed(v)
                rows.append((found[1][0], tagged(found), _running(packed(b"".join(found.get(8, [])), signed=True))))
            elif n == 4 and kind == "relations":
                found = _listed(v)
                roles, types = (packed(b"".join(found.get(i, []))) for i in (8, 10))
                refs = _running(packed(b"".join(found.get(9, [])), signed=True))
                rows.append((found[1][0], tagged(found), [{"ref": r, "type": MEMBER_TYPES[t], "role": strings[s]} for r, t, s in zip(refs, types, roles, strict=True)]))
        if single:
            ids, lons, lats, tags = zip(*single, strict=True)
            yield from points(np.array(ids, dtype=np.int64), np.array(lons, dtype=np.int64), np.array(lats, dtype=np.int64), list(tags))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), ARROW[kind], strict=True)], schema=ARROW[kind])


def _listed(data: bytes) -> dict[int, list]:
    out: dict[int, list] = {}
    for n, v in fields(data):
        out.setdefault(n, []).append(v)
    return out


class _Run(InputPartition):
    def __init__(self, path: str, places: list[tuple[int, int]]) -> None:
        self.path, self.places = path, places


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.kind = options.get("kind", "nodes")
        self.paths = sorted(p for name in options["path"].split(",") for p in glob.glob(name.removeprefix("file://")))
        if not self.paths:
            raise FileNotFoundError(options["path"])
        self.size = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            run, size = [], 0
            for kind, offset, length in blobs(path):
                if kind == "OSMHeader":
                    with open(path, "rb") as f:
                        f.seek(offset)
                        check_header(inflated(f.read(length)))
                elif kind == "OSMData":
                    if run and size + length > self.size:
                        out.append(_Run(path, run))
                        run, size = [], 0
                    run.append((offset, length))
                    size += length
            if run:
                out.append(_Run(path, run))
        return out or [_Run(self.paths[0], [])]

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            for offset, length in partition.places:
                f.seek(offset)
                yield from batches_of(inflated(f.read(length)), self.kind)


class OsmPbf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "nodes")]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_pbf(spark: SparkSession, paths: str | list[str], partition_bytes: int = PARTITION_BYTES) -> Elements:
    """Every kind of element of PBF files, lazily."""
    spark.dataSource.register(OsmPbf)
    paths = ",".join([paths] if isinstance(paths, str) else paths)
    load = lambda kind: spark.read.format("osm_pbf").option("kind", kind).option("partitionBytes", partition_bytes).load(paths)
    return Elements(load("coords"), load("nodes"), load("ways"), load("relations"))


def read_pbf_files(spark: SparkSession, paths: str | list[str]) -> Elements:
    """The same by Spark's own file access, a task per file: for stores that Python cannot open. Files must fit an executor's memory."""
    files = spark.read.format("binaryFile").load(paths)

    def load(kind: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for data in batch.column(0):
                    f = pa.BufferReader(data.as_buffer())
                    while head := f.read(4):
                        found = dict(fields(f.read(struct.unpack(">I", head)[0])))
                        block = inflated(f.read(found[3]))
                        if found[1] == b"OSMHeader":
                            check_header(block)
                        elif found[1] == b"OSMData":
                            yield from batches_of(block, kind)

        return files.select(F.col("content")).mapInArrow(run, SCHEMAS[kind])

    return Elements(*(load(k) for k in ("coords", "nodes", "ways", "relations")))
