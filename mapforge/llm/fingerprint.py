"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a line; a line is cut further where its own text says so (see BREAKS), so that a change
touches the paragraphs it is in and no others. Each paragraph is hashed to a wide vector and the vectors are
added lane by lane modulo 2^32, so a fingerprint does not depend on the order of paragraphs, and
paragraphs can be put in or taken out without the others. To the DENSE lanes (64 of 32 bits) a paragraph adds
the eight words of its SHA-256 and what 64-bit hashes of that digest, each of its own seed, give for the rest:
equal fingerprints mean equal multisets of paragraphs. To the SIGNED lanes it adds 1 or -1 by a bit of another
hash each, so the product of two documents' signed lanes estimates that of their multisets, and the cosine of the
signed lanes (with an error of about 1/sqrt(SIGNED)) tells how alike two documents are, at any length.

Only DataFrame functions. Written as 8 hex digits a lane.

Defined results: a null text is empty; an empty text has no paragraph and the fingerprint of zeros;
empty lines don't count; equal rows have equal fingerprints; rows that tie in doc_id follow each other by text;
a very long line without a break is one paragraph; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import let, shuffle_partitions

DENSE, SIGNED = 64, 64
#: Paragraphs end at line ends, after a sentence whose last letter is in the alphabet's first half, and after rarer word ends.
BREAKS = r"\n|(?<=[a-m][.!?;]\x20)|(?<=[jqxz0-9]\x20)|(?<=[\u3002\uff01\uff1f])"
LANES = DENSE + SIGNED
_MASK = (1 << 32) - 1


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAKS, -1), lambda p: p != "")


def _vector(paragraph: Column) -> Column:
    def of(digest: Column) -> Column:
        first = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(digest.substr(i * 8 + 1, F.lit(8)), 16, 10).cast("long"))
        more = F.transform(F.sequence(F.lit(8), F.lit(DENSE - 1)), lambda i: F.xxhash64(digest, i).bitwiseAND(F.lit(_MASK)))
        return F.concat(first, more)

    h = F.xxhash64(paragraph)
    signed = F.transform(F.sequence(F.lit(0), F.lit(SIGNED - 1)), lambda i: F.when(F.getbit(h, i) == 1, F.lit(1).cast("long")).otherwise(F.lit(_MASK).cast("long")))
    return F.concat(let(F.sha2(paragraph, 256), of), signed)


def lanes(parts: Column) -> Column:
    """The lanes of an array of paragraphs: 32-bit numbers as array<bigint>."""
    zero = F.array_repeat(F.lit(0).cast("long"), LANES)
    return F.aggregate(parts, zero, lambda sums, p: plus(sums, _vector(p)))


def plus(a: Column, b: Column) -> Column:
    """Lanes of both multisets together: inserting b's paragraphs into a."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(_MASK)))


def minus(a: Column, b: Column) -> Column:
    """Lanes of a without b's paragraphs."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(_MASK)))


def to_hex(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def from_hex(fingerprint: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: F.conv(fingerprint.substr(i * 8 + 1, F.lit(8)), 16, 10).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of their signed lanes, from 0 to below 1."""

    def signed(v: Column) -> Column:
        return F.transform(F.slice(v, DENSE + 1, SIGNED), lambda x: F.when(x > (_MASK >> 1), x - (_MASK + 1)).otherwise(x).cast("double"))

    sums = F.aggregate(
        F.zip_with(signed(a), signed(b), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
        F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy")),
        lambda t, p: F.struct((t["xy"] + p["x"] * p["y"]).alias("xy"), (t["xx"] + p["x"] * p["x"]).alias("xx"), (t["yy"] + p["y"] * p["y"]).alias("yy")),
        lambda t: F.when((t["xx"] > 0) & (t["yy"] > 0), t["xy"] / F.sqrt(t["xx"] * t["yy"])).otherwise(F.lit(0.0)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.99), sums)))


def with_next(documents: DataFrame, values: list[str], most_buckets: int = 65536) -> DataFrame:
    """documents with next_<value> of the next row by (doc_id, text), nulls first; after the last row the first.

    Rows are dealt to ranges of doc_id whose bounds are quantiles (at most most_buckets numbers on the
    driver). A range also gets a copy of the row that starts the next one, so one shuffle does.
    """
    spark = documents.sparkSession
    buckets = max(16, min(most_buckets, 6 * shuffle_partitions(spark)))
    low = -(1 << 63)
    key = F.coalesce("doc_id", F.lit(low))
    got = documents.select(F.percentile_approx(key, [i / buckets for i in range(buckets)], 20 * buckets).alias("q"), F.min(key).alias("lo")).first()
    bounds = sorted({got["lo"], *(got["q"] or [])}) if got["lo"] is not None else [low]
    n = len(bounds)
    starts = F.array(*[F.lit(b) for b in bounds]) if n <= 64 else F.from_json(F.lit("[" + ",".join(map(str, bounds)) + "]"), "array<bigint>")
    steps = max(1, n.bit_length())
    find = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(0).alias("lo"), F.lit(n - 1).alias("hi")),
        lambda t, _: F.transform(F.array(F.floor((t["lo"] + t["hi"] + 1) / 2).cast("int")), lambda m: F.when(F.get(starts, m) <= F.col("__key"), F.struct(m.alias("lo"), t["hi"].alias("hi"))).otherwise(F.struct(t["lo"].alias("lo"), F.greatest(t["lo"], m - 1).alias("hi"))))[0],
        lambda t: t["lo"],
    )
    rows = documents.withColumn("__key", key).withColumn("__at", find)
    before = F.when(F.col("__at") == 0, F.lit(n - 1)).otherwise(F.col("__at") - 1)
    places = F.when(
        F.get(starts, F.col("__at")) == F.col("__key"),
        F.array(F.struct(F.col("__at").alias("__bucket"), F.lit(0).alias("__ahead")), F.struct(before.alias("__bucket"), F.lit(1).alias("__ahead"))),
    ).otherwise(F.array(F.struct(F.col("__at").alias("__bucket"), F.lit(0).alias("__ahead"))))
    rows = rows.select("*", F.inline(places))
    order = Window.partitionBy("__bucket").orderBy("__ahead", "__key", F.col("text").asc_nulls_first())
    rows = rows.withColumns({f"next_{v}": F.lead(v).over(order) for v in values}).where("__ahead = 0")
    return rows.drop("__key", "__at", "__bucket", "__ahead")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of (doc_id, text)."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"n_chars": F.char_length("text").cast("long"), "lanes": lanes(paragraphs(F.col("text")))})
    docs = with_next(docs, ["text", "lanes"])
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))
    docs = docs.select("doc_id", "n_chars", "lanes", "next_lanes", F.explode(F.array(edited)).alias("edited"))
    docs = docs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "lanes", "next_lanes", F.explode(F.array(lanes(paragraphs(F.col("edited"))))).alias("edited_lanes"))
    return docs.select(
        "doc_id", "n_chars", "edited_sha256", to_hex(F.col("lanes")).alias("fingerprint"), to_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"), likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
