"""Importance resampling towards a target corpus by hashed word n-grams.

Words are cut at the level of bytes: one table of 256 bytes lower-cases A-Z and blanks every ASCII byte that is no digit
or letter, ``bytes.split`` gives the words, and a feature's crc32 goes on from the crc32 of the feature one word shorter.
Features are counted in the tasks, bucket by bucket; a document's weight is the sum of its features' gains, Gumbel noise
from a hash of its id makes the draw, and the highest scores are drawn.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import binary, pieces, small_batches
from millrace.plans.numbering import numbered
from millrace.plans.storage import materialize

BUCKETS = 10_000
HELD = 1 << 20  # features that a task counts before it adds them up by bucket
KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
TABLE = bytes(b if b in KEPT else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def features_of(text: bytes | None, longest: int = 1) -> tuple[int, list[int]]:
    """The number of words and the crc32 of every run of 1 to ``longest`` words joined by a space; none for NULL."""
    words = text.translate(TABLE).split() if text else []
    runs = found = list(map(crc32, words))
    following = [b" " + w for w in words] if longest > 1 else []
    for k in range(1, longest):
        runs = list(map(crc32, following[k:], runs))
        found = found + runs
    return len(words), found


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (the one column of ``texts``) by bucket; a task sends a row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = np.zeros(buckets, np.int64), Counter()

        def add() -> None:
            n = len(held)
            np.add.at(sums, np.fromiter(held, np.int64, n) % buckets, np.fromiter(held.values(), np.int64, n))
            held.clear()

        for batch in (p for b in batches for p in pieces(b)):
            for text in binary(batch.column(0)):
                held.update(features_of(text, longest)[1])
                if len(held) > HELD:
                    add()
        add()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    parts = small_batches(texts).mapInArrow(count, "bucket bigint, n bigint")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # `buckets` rows at most
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: a thousand times the log of its smoothed share of the target over that of the source, rounded down."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1) * (s_all + k) / ((s + 1) * (t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, doc_id: Column) -> Column:
    """Gumbel noise times a thousand, rounded down, from the first 8 hex digits of sha256 of ``seed:id``; no id counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def weighed(docs: DataFrame, gains: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row (columns ``doc_id, text``)."""
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_features": pa.int64(), "weight": pa.int64()}

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            rows = []
            for text in binary(batch.column(1)):
                n, found = features_of(text, longest)
                rows.append((n, len(found), int(gains[np.fromiter(found, np.int64, len(found)) % len(gains)].sum())))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, list(kinds))

    return small_batches(docs).mapInArrow(weigh, ", ".join(f"{c} bigint" for c in kinds))


def resampled(
    docs: DataFrame, target: DataFrame, *, longest: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is NULL where a row is not drawn.

    Drawn are ``percent`` of the rows with ``least_words`` words or more, rounded down, by the highest scores, equal ones by
    smaller id (rows without an id last, then by fewer features; rows equal in all this are alike in the result).  A NULL text
    is an empty one: no features, weight 0, never drawn unless ``least_words`` is 0.  Repeated rows count each time, and the
    noise of equal ids is equal.  Empty tables give no rows or, as ``target``, counts of 0.  Other columns are not read.
    Texts are read whole, whatever their length.
    """
    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    gains = gains_of(bucket_counts(named.select("text"), longest, buckets), bucket_counts(target.select(text), longest, buckets))
    rows = weighed(named, gains, longest).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id")))
    rows = materialize(rows, "weights")
    able = rows.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = numbered(able, order, name="rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
