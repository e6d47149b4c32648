"""WARC archives with an index: written by executors, read by coalesced byte ranges.

Writing: every record is a gzip member of its own, so it can be read by itself. Each task writes one
archive under a name of its attempt, a warcinfo record first, and returns the index rows of its records; the
index table is the commit: an archive of a failed attempt is in no index row and is never read. A response's
block is an HTTP head and the payload, as readers of WARC 1.1 expect; record ids are UUIDs. Records with equal
payloads (by SHA-1, SHA-256 and length) of at least ``min_bytes``: the one of the largest page_id is the response,
others are revisits that refer to it and carry the HTTP head alone.

Reading: the wanted index rows are sorted by archive and offset, ranges that follow each other (or
leave a gap of at most ``gap``) are fetched as one read of at most ``most`` bytes, and each record is
parsed from its headers.

Archives go through pyarrow's file systems (file, s3, gs, hdfs), in the shared scratch folder.

Defined results: a null html is an empty payload; a null url is written as the target urn:x-page:<page_id> and
read as null; a null page_id is below all others; rows equal in page_id and payload are all responses, of one
record id; urls keep characters that a header cannot hold (they are quoted there and given in full beside it);
very long payloads take one record's memory; no rows give no archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import lookup, scratch_path, shuffle_partitions, whole_texts, written

INDEX = "page_id long, url string, archive string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(h.substr(at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def typed(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    The largest page_id of each payload is aggregated before the shuffle and only payloads that occur
    again are looked up; the html itself is shuffled once.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": digest(F.col("payload"))})
    rows = rows.withColumn("k", F.concat_ws(":", "payload_digest", "payload_bytes", F.sha2("payload", 256)))
    many = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("k").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    rows = lookup(rows, written(many.where("n > 1"), "warc-copies"), "k", "n", pages.count())
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("last")).alias("refers_to"),
    )


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.split(":", 1)[1].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _record_id(page_id: int | None, payload_digest: str, payload_bytes: int) -> str:
    """The id of a page's response: known to revisits without a look at the archive that holds it."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"urn:x-page:{page_id}:{payload_digest}:{payload_bytes}").urn


def _record(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """A record as a gzip member."""
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return gz.compress(head.encode() + b"\r\n") + gz.compress(block) + gz.compress(b"\r\n\r\n") + gz.flush()


def _page(row: dict, date: str, level: int) -> bytes:
    """The record of a typed page."""
    revisit = row["record_type"] == "revisit"
    page = "" if row["page_id"] is None else str(row["page_id"])
    target = f"urn:x-page:{page}" if row["url"] is None else quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~")
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{uuid.uuid4().urn if revisit else _record_id(row['page_id'], row['payload_digest'], row['payload_bytes'])}>"),
        ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("X-Page-ID", page), ("X-Payload-Length", str(row["payload_bytes"])),
    ]
    if target != row["url"]:
        fields.append(("X-Target-JSON", json.dumps(row["url"])))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_record_id(row['refers_to'], row['payload_digest'], row['payload_bytes'])}>"), ("X-Refers-To-Page-ID", str(row["refers_to"])),
        ]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    return _record(fields, http if revisit else http + row["payload"], level)


def _parse(member: bytes) -> dict:
    head, _, body = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(fields["Content-Length"])
    if body[size:] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    number = lambda name: int(fields[name]) if fields[name] else None
    revisit = fields["WARC-Type"] == "revisit"
    payload = body[:size].partition(b"\r\n\r\n")[2]
    claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (base64.b32encode(hashlib.sha1(payload).digest()).decode() != claimed or len(payload) != number("X-Payload-Length")):
        raise ValueError("a payload differs from its digest")
    return {
        "page_id": number("X-Page-ID"), "url": json.loads(fields["X-Target-JSON"]) if "X-Target-JSON" in fields else fields["WARC-Target-URI"],
        "payload_bytes": number("X-Payload-Length"), "payload_digest": claimed,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID") if revisit else None, "payload": None if revisit else payload,
    }


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            yield from batch.slice(i, 64).to_pylist()


def _schema(kind: str) -> pa.Schema:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, types[t]) for name, t in (x.strip().split() for x in kind.split(","))])


def _writer(folder: str, level: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    index = _schema(INDEX)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        out, name, at, rows = None, f"{uuid.uuid4().hex}.warc.gz", 0, []
        for row in _rows(batches):
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
                info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
                member = _record(info, b"software: mapforge\r\nformat: WARC File Format 1.1\r\n", level)
                out.write(member)
                at = len(member)
            member = _page(row, date, level)
            out.write(member)
            rows.append({k: row[k] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")} | {"archive": f"{folder}/{name}", "offset": at, "length": len(member)})
            at += len(member)
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows, schema=index)
                rows = []
        if out is not None:
            out.close()  # before the last rows are given away: an index row means a whole archive
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=index)

    return write


def write_archives(pages: DataFrame, folder: str | None = None, *, min_bytes: int = 0, level: int = 4, date: str | None = None) -> DataFrame:
    """Write a record per page below folder (fresh in the scratch folder if None); returns the index, a written table.

    date is that of the records (like 2026-01-31T00:00:00Z; now if None).
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return written(typed(pages, min_bytes).mapInArrow(_writer(folder, level, date), INDEX), "warc-index")


def _reader(gap: int, most: int, payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = _schema(RECORD)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, opened, run = None, None, []

        def fetched() -> Iterator[dict]:
            start, end = run[0]["offset"], max(x["offset"] + x["length"] for x in run)
            handle.seek(start)
            data = memoryview(handle.read(end - start))
            for x in run:
                at = x["offset"] - start
                got = _parse(zlib.decompress(data[at : at + x["length"]], 31))
                yield got if payloads else got | {"payload": None}

        out, held = [], 0
        for x in _rows(batches):
            if run and (x["archive"] != opened or x["offset"] > run[-1]["offset"] + run[-1]["length"] + gap or x["offset"] + x["length"] - run[0]["offset"] > most):
                for r in fetched():
                    out.append(r)
                    held += len(r["payload"] or b"")
                    if len(out) >= 2048 or held > most:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
                run = []
            if x["archive"] != opened:
                fs, path = _filesystem(x["archive"])
                if handle is not None:
                    handle.close()
                handle, opened = fs.open_input_file(path), x["archive"]
            run.append(x)
        if run:
            out += fetched()
        if handle is not None:
            handle.close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return read


def read_records(index: DataFrame, *, payloads: bool = True, gap: int = 64 << 10, most: int = 8 << 20) -> DataFrame:
    """The records of (archive, offset, length) rows; a revisit's payload is null, its refers_to names the response."""
    whole_texts(index.sparkSession)
    wanted = index.select("archive", "offset", "length")
    wanted = wanted.repartitionByRange(shuffle_partitions(index.sparkSession), "archive", "offset").sortWithinPartitions("archive", "offset")
    return wanted.mapInArrow(_reader(gap, most, payloads), RECORD)


def members(data: bytes) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record of an archive's bytes but its warcinfo: an index from nothing but the archive."""
    at = 0
    while at < len(data):
        gz = zlib.decompressobj(31)
        stream = io.BytesIO(data[at:])
        start = gz.decompress(stream.read(1 << 16))
        while not gz.eof:
            gz.decompress(stream.read(1 << 16))
        length = stream.tell() - len(gz.unused_data)
        if b"\r\nWARC-Type: warcinfo\r\n" not in start.partition(b"\r\n\r\n")[0]:
            yield at, length
        at += length
