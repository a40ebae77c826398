"""A training corpus from raw documents: language, near duplicates, benchmark passages, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, minhash, packing, pii
from millrace.plans.storage import materialize

ORACLE_SQL = None  # learning, hashing and tokenizing are beyond SQL; the tests compare with brute force


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rows are told apart by id and text, so a repeated or NULL id does no harm.

    NULL and blank texts go; no documents give none.
    """
    found = langid.identify_documents(docs).filter(~F.col("kept"))
    gone = materialize(found.select(F.col("doc_id").alias("_doc"), F.col("body_hash").alias("_hash")).distinct(), "rejected")
    same = (F.xxhash64("text") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    return docs.join(gone, same, "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 80 percent).

    Rows that repeat an id and a text stay once, as the least in their other columns, NULL first.  Rows without an id stay.
    """
    found = minhash.near_duplicates(docs, shingle=5, pct=80)
    gone = materialize(found.filter(~F.col("kept")).select("doc_id").distinct(), "duplicates")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    again = materialize(again, "repeated")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = left.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_row"))
    once = least.select("doc_id", "text", *(F.col(f"_row.{c}").alias(c) for c in others))
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; each row by its own text, whatever its id, and NULL and empty texts stay."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text.  NULL texts stay NULL, repeated rows stay."""
    chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return pii.masked(docs).withColumn("n_chars", chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row for each piece of a document; NULL and empty texts are an end token."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), tokens=2048, end_id=1)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
