"""Language identification by rank-order profiles of character n-grams.

A profile is the most frequent n-grams of a text, by rank: n-grams of one to three characters of its
lower-cased letters, each other run of characters being one blank; none reaches over a blank. A language's profile is counted
over the whole texts of all its training documents. A document goes to the language whose profile is
least out of place: the sum over the document's n-grams of the difference of ranks, at most
``size`` for an n-gram that the language's profile lacks. The score is 1 minus the best distance as
a share of the largest possible one.

Counting is vectorised over Arrow batches: three characters fit one 64-bit number. Tasks count their
documents, counts are added by Spark, and the profiles (``size`` rows a language) go to the driver.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if
nothing was learned; ties go to the language first by code point; equal texts get equal results;
documents with a null lang teach nothing; n-grams equally frequent rank by their characters; very long texts are
counted in pieces; no rows give no rows and teach nothing; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .runtime import whole_texts
from .textkit import release

SIZE = 300
_PIECE = 1 << 18
_BLANK = 1
_letters: dict[str, np.ndarray] = {}


def _table() -> np.ndarray:
    """Code point to lower-case letter, 1 for all others; made on first use of each process."""
    if "t" not in _letters:
        t = np.full(0x110000, _BLANK, dtype=np.int32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                t[c] = ord(low) if len(low) == 1 else c
        _letters["t"] = t
    return _letters["t"]


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers, ascending, and their counts. Those of a blank alone don't count."""
    found: tuple[np.ndarray, np.ndarray] | None = None
    last = np.full(2, _BLANK, dtype=np.int64)
    for at in range(0, len(text), _PIECE):
        codes = _table()[np.frombuffer(text[at : at + _PIECE].encode("utf-32-le", "replace"), dtype=np.uint32)].astype(np.int64)
        codes = codes[~((codes == _BLANK) & (np.concatenate([last[-1:], codes[:-1]]) == _BLANK))]
        end = at + _PIECE >= len(text)
        c = np.concatenate([last, codes, np.full(1, _BLANK, dtype=np.int64)[: int(end)]])
        one, two, three = c[2:], (c[1:-1] << 21) | c[2:], (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
        middle = c[1:-1] != _BLANK
        blank_pair = (c[1:-1] == _BLANK) & (c[2:] == _BLANK)
        all_grams = np.concatenate([one[one != _BLANK], two[~blank_pair], three[middle]])
        grams, counts = np.unique(all_grams, return_counts=True)
        if found is not None:
            both, place = np.unique(np.concatenate([found[0], grams]), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate([found[1], counts])).astype(np.int64)
            grams = both
        found = grams, counts
        if len(c) >= 2:
            last = c[-2:]
    return found if found is not None else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def _top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))][:size]


def profiles(documents: DataFrame, size: int = SIZE) -> dict[str, list[int]]:
    """Language to its n-grams by rank, from the whole texts of (text, lang).

    A language's ranks are taken from salted shares first, so that no language meets in one task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        pending: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def add() -> None:
            for lang, parts in pending.items():
                parts = parts + ([sums[lang]] if lang in sums else [])
                grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                sums[lang] = grams, np.bincount(place, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            pending.clear()

        def give() -> Iterator[pa.RecordBatch]:
            for lang, (grams, counts) in sums.items():
                for i in range(0, len(grams), 10000):
                    g = grams[i : i + 10000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g), pa.array(counts[i : i + 10000])], names=["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                piece = batch.slice(i, 64)
                for lang, text in zip(piece.column(1).to_pylist(), piece.column(0).to_pylist(), strict=True):
                    grams = _grams(text)
                    pending.setdefault(lang, []).append(grams)
                    waiting += len(grams[0])
                    if waiting > 1 << 18:
                        add()
                        waiting = 0
            if sum(len(s[0]) for s in sums.values()) > 1 << 19:
                add()
                yield from give()
        add()
        yield from give()
        release()

    whole_texts(documents.sparkSession)
    counted = documents.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(32)))
    for keys in (["lang", "salt"], ["lang"]):
        w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "gram")
        salted = salted.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).drop("r")
    out: dict[str, list[int]] = {}
    for r in sorted(salted.select("lang", "gram", "n").collect(), key=lambda r: (-r["n"], r["gram"])):  # size rows a language
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: out[k] for k in sorted(out, key=lambda s: s.encode())}


def classify(text: str | None, languages: list[str], grams: np.ndarray, ranks: np.ndarray, size: int) -> tuple[str, float]:
    """One text against all profiles: grams ascending, ranks[gram, language] (``size`` where it lacks it)."""
    if text is None or not languages:
        return "und", 0.0
    found = _top(*_grams(text), size)
    if not len(found):
        return "und", 0.0
    at = np.searchsorted(grams, found)
    at[at == len(grams)] = 0
    there = grams[at] == found
    own = np.arange(len(found))[:, None]
    distance = np.where(there[:, None], np.abs(ranks[at] - own) * (ranks[at] < size) + size * (ranks[at] >= size), size).sum(axis=0)
    best = int(distance.argmin())
    return languages[best], float(1 - distance[best] / (size * len(found)))


def predict(documents: DataFrame, learned: dict[str, list[int]], size: int = SIZE) -> DataFrame:
    """documents with lang_pred and score."""
    languages = list(learned)
    grams = np.unique(np.array([g for p in learned.values() for g in p] or [0], dtype=np.int64))
    ranks = np.full((len(grams), max(1, len(languages))), size, dtype=np.int64)
    for j, p in enumerate(learned.values()):
        ranks[np.searchsorted(grams, np.array(p, dtype=np.int64)), j] = np.arange(len(p))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [classify(t.as_py(), languages, grams, ranks, size) for t in part.column(0)]
                columns = [*part.columns[1:], pa.array([f[0] for f in found]), pa.array([f[1] for f in found], type=pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[1:], "lang_pred", "score"])
        release()

    whole_texts(documents.sparkSession)
    # The other columns travel as one, so that none can clash with those added.
    row = F.struct(*documents.columns).alias("row")
    kind = T.StructType([T.StructField("row", documents.select(row).schema["row"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return documents.select("text", row).mapInArrow(guess, kind).select("row.*", "lang_pred", "score")
