"""One registered query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import brown, cascade, decontam, langid, minhash, negatives, packing, pii, resample, sharding, subwords, toxicity, wavelet
from millrace.plans.storage import fresh_path


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf, "documents"))


def op2_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), shingle=4)


def op3_wavelet_tokens(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    wavelet.write_tokens(_table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return wavelet.read_documents(spark, path)


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), tokens=2048, end_id=1)


def conversation_packing(spark: SparkSession, sf: str) -> DataFrame:
    """The operator of op4 on instruction data: only what the assistant says bears loss, and all three limits bind."""
    return packing.pack_conversations(_table(spark, sf, "conversations"), public_tokenizers.path("word_bpe_49k.json"), tokens=2048, segments=16, loss=1024, end_id=1)


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return cascade.quality(_table(spark, sf, "documents")).drop("rule")


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify_documents(_table(spark, sf, "documents")).drop("body_hash")


def page_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The operator of op6 where all its evidence is there: markup, addresses and hosts of pages."""
    found = langid.identify_pages(_table(spark, sf, "pages"), _table(spark, sf, "documents"))
    return found.withColumnRenamed("doc_id", "page_id").drop("body_hash")


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return toxicity.scored(docs, toxicity.learnt(docs, _table(spark, sf, "labels")))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op9_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(_table(spark, sf, "documents")))


def op10_class_lm(spark: SparkSession, sf: str) -> DataFrame:
    return brown.score_documents(_table(spark, sf, "documents"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf, "embeddings").withColumn("label", moved))


def op12_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return subwords.digests(_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample.resampled(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_minhash": op2_minhash,
    "op3_wavelet_tokens": op3_wavelet_tokens,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_personal_data": op9_personal_data,
    "op10_class_lm": op10_class_lm,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_resampling": op13_resampling,
    "page_language_id": page_language_id,
    "conversation_packing": conversation_packing,
}

# The crc32 table by its rule: eight halvings of each byte, with the fixed polynomial.
CRC_TABLE = """
    WITH RECURSIVE halved AS (
        SELECT b::UBIGINT AS b, b::UBIGINT AS v, 0 AS k FROM range(256) r(b)
        UNION ALL
        SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM halved WHERE k < 8)
    SELECT list(v ORDER BY b) AS crc FROM halved WHERE k = 8
"""

ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
        WITH ok AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
             AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
        WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY row_number() OVER w <= 3
    """,
    "op13_resampling": f"""
        WITH crc_table AS MATERIALIZED ({CRC_TABLE}),
        texts AS (
            SELECT 0 AS side, doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 1, NULL, NULL, coalesce(text, '') FROM benchmark),
        words AS (
            SELECT side, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM texts),
        counted AS MATERIALIZED (SELECT side, row, word, count(*) AS n FROM words GROUP BY ALL),
        hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)),
        buckets AS MATERIALIZED (
            SELECT word, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: (16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1)
                       + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)::UBIGINT),
                       lambda v, b: xor(v >> 8, crc[(xor(v, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS bucket
            FROM hexed, crc_table),
        sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
            FROM counted JOIN buckets USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain
            FROM sums),
        weights AS (
            SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM counted JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (row) WHERE side = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) * 10 // 100 AS drawn
            FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
    """,
}
