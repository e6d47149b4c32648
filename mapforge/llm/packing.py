"""Best-fit packing of tokenised documents into sequences, in bulk-synchronous steps.

A document is its token ids and an end id; longer ones than a sequence are cut from the end, so that
only the first piece may be short. Pieces and open gaps are kept sorted by length as runs of equals, at
most ``capacity`` of each however many documents there are. A superstep takes the longest run that is
not placed: a successor sweep finds the tightest gap that holds it, the run's pieces go to that gap
run's sequences by rank (so no two want one place), gaps are updated, and the sweep repeats; what finds
no gap opens sequences. This gives what best-fit decreasing gives piece by piece. Counting the runs,
ranking pieces within their run (no run meets in one task) and placing them is distributed.

Token ids are those of the tokenizer file by the ``tokenizers`` library. Texts of common Latin letters
are encoded with the same vocabulary by ``tiktoken``, which gives the same ids in a third of the time;
all others, and those that hold an added token, by ``tokenizers`` itself. No tokenizer is trained.

Defined results: a null text is empty and has the end id alone; rows equal in all are packed one by
one; very long texts are encoded in parts cut before a space, which changes no id; no rows give no
rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ranked, written
from .textkit import release

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters on whose classes (letter, number, space) all regular expression engines agree.
_UNCOMMON = re.compile("[^\t\n\r\x20-\x7e¿-ÖØ-öø-ſ]|<\\|")
_PART = 1 << 20
_loaded: dict[tuple, object] = {}


class Place(NamedTuple):
    """Pieces of one length with ranks from first to end (excluded) go to sequences from ``sequence`` on, ``each`` to one, from ``offset`` on."""

    length: int
    first: int
    end: int
    sequence: int
    each: int
    offset: int


def best_fit(runs: dict[int, int], capacity: int) -> list[Place]:
    """Places for runs (length to number of pieces), longest first."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap to runs of sequences (first, number)
    sizes: list[int] = []  # the gaps, ascending
    places: list[Place] = []
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(runs, reverse=True):
        rank, left = 0, runs[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                n = -(-left // (capacity // length))
                add(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            each = gap // length
            used = min(left, n * each)
            full, rest = divmod(used, each)
            places.append(Place(length, rank, rank + used, first, each, capacity - gap))
            add(gap - each * length, first, full)
            add(gap - rest * length, first + full, int(rest > 0))
            add(gap, first + full + (rest > 0), n - full - (rest > 0))
            rank, left = rank + used, left - used
    return places


def _parts(text: str) -> Iterator[str]:
    """text in parts cut before a single space after another character, where a token always begins."""
    at = 0
    while len(text) - at > _PART:
        cut = text.find(" ", at + _PART)
        while cut > 0 and (text[cut - 1].isspace() or (cut + 1 < len(text) and text[cut + 1].isspace())):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _encoder(tokenizer_path: str | None, ranks_path: str | None):
    """text -> ids, loaded once a task: workers that wait for other tasks hold no vocabulary."""
    key = (tokenizer_path, ranks_path)
    if key not in _loaded:
        import base64

        import public_tokenizers as public
        import tiktoken

        exact, fast = None, None
        if tokenizer_path is None or ranks_path is not None:
            with open(ranks_path or public.path("byte_bpe_50k.tiktoken"), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def exactly(text: str) -> list[int]:
            nonlocal exact
            if exact is None:  # most tasks meet no text that needs it
                from tokenizers import Tokenizer

                exact = Tokenizer.from_file(tokenizer_path or public.path("byte_bpe_50k.json"))
            return exact.encode(text, add_special_tokens=False).ids

        def encode(text: str) -> array:
            ids = array("I")
            for part in _parts(text):
                if fast is not None and not _UNCOMMON.search(part):
                    ids.extend(fast.encode_ordinary(part))
                else:
                    ids.extend(exactly(part))
            return ids

        _loaded[key] = encode
    return _loaded[key]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenised(documents: DataFrame, capacity: int, end_id: int, tokenizer_path: str | None, ranks_path: str | None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _encoder(tokenizer_path, ranks_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = ids_of(text.as_py() or "")
                ids.append(end_id)
                data = np.frombuffer(ids, dtype=np.uint32).astype("<u4", copy=False)
                rows += [(doc_id.as_py(), k, s, n, zlib.crc32(data[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        del ids_of
        _loaded.clear()
        release()

    return documents.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(encode, PIECES)


def pack(
    documents: DataFrame, *, capacity: int = 2048, end_id: int = 0, tokenizer_path: str | None = None, ranks_path: str | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of (doc_id, text)."""
    spark = documents.sparkSession
    pieces = written(tokenised(documents, capacity, end_id, tokenizer_path, ranks_path), "pieces")
    runs = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    rows: dict[int, list[tuple]] = {}
    for p in best_fit(runs, capacity):
        rows.setdefault(p.length, []).append(tuple(p[1:]))
    table = spark.createDataFrame([(k, v) for k, v in rows.items()], "length long, places array<struct<first:long,end:long,sequence:long,each:long,at:long>>")
    placed = ranked(pieces.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32")), ["length"], "h", ["doc_id", "piece", "ids_crc32"])
    steps = max(1, max((len(v) for v in rows.values()), default=1).bit_length())
    # The place whose ranks hold this one, by bisection over the run's places in order of rank.
    index = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0).alias("lo"), (F.size("places") - 1).alias("hi")),
        lambda t, _: F.transform(F.array(F.floor((t["lo"] + t["hi"]) / 2).cast("int")), lambda m: F.when(F.get(F.col("places"), m)["end"] > F.col("rank"), F.struct(t["lo"].alias("lo"), m.alias("hi"))).otherwise(F.struct(F.least(t["hi"], m + 1).alias("lo"), t["hi"].alias("hi"))))[0],
        lambda t: t["hi"],
    )
    found = placed.join(F.broadcast(table), "length").withColumn("p", F.get("places", index))
    nth = F.col("rank") - F.col("p.first")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("p.sequence") + F.floor(nth / F.col("p.each"))).cast("long").alias("sequence_id"), (F.col("p.at") + (nth % F.col("p.each")) * F.col("length")).cast("long").alias("offset"),
    )
