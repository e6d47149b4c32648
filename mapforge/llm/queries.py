"""The registered queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii, joined

    found = find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False).withColumn("base", F.filter("spans", lambda s: s["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import read_records, write_archives

    return read_records(write_archives(_table(spark, sf_dir, "pages")), payloads=False).drop("payload", "url")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import predict, profiles

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1)
    learned = profiles(docs.where("NOT held_out"))
    return predict(docs.select("doc_id", "text", "held_out"), learned).select("doc_id", "held_out", "lang_pred", "score")


#: The filter's rules: host and path, and what they say.
RULES = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge

    return judge(_table(spark, sf_dir, "pages"), RULES)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, taken_words

    return taken_words(mix(_table(spark, sf_dir, "documents")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import fingerprints

    return fingerprints(_table(spark, sf_dir, "documents"))


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_copies

    return near_copies(_table(spark, sf_dir, "documents"), k=3, percent=90)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import without_repeats

    return without_repeats(_table(spark, sf_dir, "documents"), window=35).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_warc": op2_warc,
    "op3_langid": op3_langid,
    "op4_urls": op4_urls,
    "op5_mixing": op5_mixing,
    "op6_fingerprints": op6_fingerprints,
    "op7_vectors": op7_vectors,
    "op8_jaccard": op8_jaccard,
    "op9_repeats": op9_repeats,
    "op10_packing": op10_packing,
}
_B32 = "translate(" + " || ".join(f"to_base(cast('0x' || substr(h, {at}, {n}) AS BIGINT), 32, {n * 4 // 5})" for at, n in ((1, 15), (16, 15), (31, 10))) + ", '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
ORACLES: dict[str, str] = {
    "op2_warc": f"""
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
               CASE WHEN page_id = last OR last IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = last OR last IS NULL THEN NULL ELSE last END AS refers_to
        FROM p""",
}
