"""Word, bigram and predecessor statistics.

Input: a DataFrame with a string column (``line`` unless named otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.words import segment_texts, words_of
from millrace.plans.storage import materialize


def segments(lines: DataFrame, text: str = "line") -> DataFrame:
    """``words ARRAY<STRING>``: one row per sentence segment that has at least one word."""
    return _segments(lines, text).filter(F.size("words") > 0)


def multiword(segs: DataFrame) -> DataFrame:
    """Segments of two words or more."""
    return segs.filter(F.size("words") > 1)


def word_counts(lines: DataFrame, text: str = "line") -> DataFrame:
    """``word, n``.  Segments do not matter for counting, so words come straight from the line."""
    return (
        lines.select(F.explode(words_of(F.lower(F.col(text)))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def bigrams(segs: DataFrame) -> DataFrame:
    """``word, pred`` for each word with the word before it in its segment; ``pred`` is NULL for the first."""
    before = F.array_prepend("words", F.lit(None).cast("string"))
    return segs.select(F.inline(F.arrays_zip(F.col("words").alias("word"), before.alias("pred")))).filter(
        F.col("word").isNotNull()
    )


def bigram_counts(lines: DataFrame, text: str = "line") -> DataFrame:
    """``word, pred, n``: how often ``pred`` directly precedes ``word``; never across a segment."""
    return _pair_counts(lines, text).filter(F.col("pred").isNotNull())


def word_freq(lines: DataFrame, text: str = "line") -> DataFrame:
    """``word, n, pred, pred_n``: words by count, each with its predecessors by count.

    A word that only ever opens segments has one row with NULL ``pred``.  Every
    occurrence of a word is in exactly one pair count (first words count under a
    NULL predecessor), so the text is read once and totals are sums of pair counts.
    """
    pairs, totals = _pairs_and_totals(lines, text)
    return (
        pairs.join(totals, "word")
        .filter(F.col("pred").isNotNull() | (F.col("preds") == 0))
        .select("word", "n", "pred", F.when(F.col("pred").isNotNull(), F.col("pair_n")).alias("pred_n"))
        .orderBy(F.desc("n"), "word", F.desc("pred_n"), "pred")
    )


def predecessor_lists(lines: DataFrame, text: str = "line") -> DataFrame:
    """``word, pred, n``: each predecessor of each word; a word that only ever opens segments has NULL ``pred`` and ``n``."""
    pairs, totals = _pairs_and_totals(lines, text)
    lonely = totals.filter("preds = 0").select("word", F.lit(None).cast("string").alias("pred"), F.lit(None).cast("bigint").alias("n"))
    return pairs.filter("pred IS NOT NULL").select("word", "pred", F.col("pair_n").alias("n")).unionByName(lonely)


def _segments(lines: DataFrame, text: str) -> DataFrame:
    pieces = lines.select(F.explode(segment_texts(F.col(text))).alias("segment"))
    return pieces.select(words_of(F.col("segment")).alias("words"))


def _pair_counts(lines: DataFrame, text: str) -> DataFrame:
    return bigrams(_segments(lines, text)).groupBy("word", "pred").agg(F.count("*").alias("n"))


def _pairs_and_totals(lines: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Pair counts and word totals, both written: a join of the two then has plain shuffles, which split a hot word."""
    pairs = materialize(_pair_counts(lines, text).withColumnRenamed("n", "pair_n"), "pairs")
    totals = materialize(pairs.groupBy("word").agg(F.sum("pair_n").alias("n"), F.count("pred").alias("preds")), "totals")
    return pairs, totals
