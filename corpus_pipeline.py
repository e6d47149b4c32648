"""Documents to packed training sequences: language, near copies, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; run() writes each
stage's result to the shared scratch folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapforge.llm import jaccard, langid, mixing, packing, pii, runtime

#: A text this far from every profile (as a share of the largest distance) is in no known language.
LEAST_SCORE = 0.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. Those whose text is null, has no letter or fits no profile go.

    Profiles are learned from the given lang of two thirds of the documents (crc32(doc_id as text) mod 3 not 1). A given
    lang stays; a null one becomes the language found. No labelled document: all go, as nothing is known. Ties, equal
    rows and very long texts are as in langid; no rows give no rows; all columns are kept.
    """
    share = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 != 1
    learned = langid.profiles(docs.where(share).select("text", "lang"))
    found = langid.predict(docs.select(F.struct("*").alias("document"), "text"), learned).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    given = F.coalesce(F.col("document.lang"), F.col("lang_pred"))
    return found.select(*[(given if c == "lang" else F.col("document").getField(c)).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): that with the smallest doc_id, null last.

    Documents without words stay; rows equal in a non-null doc_id and text are one document; of rows that tie in
    doc_id the text with the smaller hash stays; very long texts are hashed in pieces; no rows give no rows; all columns
    are kept.
    """
    return jaccard.deduplicated(docs, k=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data in them gives way to its kind in angle brackets.

    A null or empty text becomes an empty one; equal rows stay equal; spans that overlap give one mark each, in the
    order of their starts; very long texts are searched whole; no rows give no rows; all columns are kept.
    """
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each copy, in the shuffled order of its shards.

    A null or empty text has no words, so the mix takes nothing of it and it goes. Equal rows are mixed one by one; ties
    of hashes go by doc_id; very long texts are cut at whole words; no rows give no rows; all columns are kept.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences.

    A null or empty text has its end id alone; equal rows are packed one by one; ties of lengths go by hash, then
    doc_id; very long texts are encoded in parts; no rows give no rows; other columns are ignored.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("packing", packed),
]
#: Training profiles, near copies and tokens are beyond SQL; tests/llm/test_pipeline.py holds each stage against brute force, and run() against its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = runtime.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
