"""Toxic passages as maximum-scoring segments of token log-odds.

Words get log-odds of toxic against other texts with an informative Dirichlet prior (their share in all texts), and
those that stand out for toxic texts keep them as scores; every other token scores a small negative number, the log-odds
that a token is none of them.  One pass over a text finds all maximal scoring segments.  The scores of random text
follow an extreme-value law, whose decay rate comes from the scores themselves and whose scale from texts that are not
toxic; a segment's expected number of chance equals grades it.  A text's statistic adds up the grades of all its segments
that stand out, and is calibrated by logistic regression on labelled texts kept out of the word counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import LOWER, binary, pieces, small_batches
from millrace.plans.storage import materialize

SAMPLE_ROWS = 40_000  # labelled rows that are learnt from, about
PRIOR_SHARE = 0.1  # the prior counts as so many times the observed tokens
LEAST_Z = 2.8
LEAST_TEXTS = 3
SIGNIFICANT = 0.05
FLOOR = -12.0  # the statistic of a text without any scoring word
LETTERS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters outside ASCII."""
    return text.translate(LETTERS).split() if text else []


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``first, last, score`` of tokens that score ``drift`` except at the ``hits``.

    Candidates are kept with the running sums before and after them; a new one that reaches a higher sum than an
    earlier one, which began lower, swallows everything in between.  Segments begin and end at hits.
    """
    found: list[tuple[int, int, float, float]] = []
    total, place = 0.0, -1
    for at, score in hits:
        total += drift * (at - place - 1)
        first, last, left, right = at, at, total, total + score
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k -= 1
            if k < 0 or found[k][3] >= right:
                break
            first, left = found[k][0], found[k][2]
            del found[k:]
        found.append((first, last, left, right))
        total, place = total + score, at
    return [(a, b, right - left) for a, b, left, right in found]


@dataclass
class Model:
    scores: dict[bytes, float] = field(default_factory=dict)
    drift: float = -1.0
    rate: float = 1.0  # decay of the extreme-value law
    scale: float = 1.0  # its K
    slope: float = 0.0
    middle: float = 0.0

    def found(self, text: bytes | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = tokens(text)
        return len(words), segments([(i, self.scores[w]) for i, w in enumerate(words) if w in self.scores], self.drift)

    def statistic(self, n: int, parts: list[tuple[int, int, float]]) -> float:
        """Minus the log of the expected number of chance equals, added up over the segments with less than one of them.

        Where there is none, that of the best segment.
        """
        grades = [self.rate * s - math.log(self.scale * max(n, 1)) for _, _, s in parts]
        return max(FLOOR, sum(g for g in grades if g > 0) or max(grades)) if parts else FLOOR

    def score(self, statistic: float) -> float:
        if not self.scores or not self.slope:
            return 0.0
        return 1.0 / (1.0 + math.exp(min(60.0, max(-60.0, -self.slope * (statistic - self.middle)))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnt(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from about ``sample_rows`` labelled rows that are not held out, dealt by a hash; three quarters count words."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    chosen = materialize(chosen, "labelled")
    # The sample has a documented bound, about 16 bytes a row.
    texts = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # Equal texts count once, toxic if any of them is.
    texts = materialize(texts.filter("text IS NOT NULL").groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")
    tuned = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(4)) == 0
    model = _word_scores(texts.filter(~tuned))
    if model.scores:
        _calibrate(model, texts.filter(tuned))
    return model


def _word_scores(texts: DataFrame) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        size = [0, 0]
        for batch in batches:
            for text, toxic in zip(binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                size[toxic] += len(words)
                for w in set(words):
                    seen.setdefault(w, [0, 0])[toxic] += 1
        seen[b""] = size  # tokens in all
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), *(pa.array([v[k] for v in seen.values()], pa.int64()) for k in (0, 1))], ["word", "clean", "toxic"]
        )

    counts = texts.select("text", "toxic").mapInArrow(count, "word binary, clean bigint, toxic bigint")
    counts = materialize(counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "words")
    is_word = F.length("word") > 0
    n = counts.agg(*(F.sum(F.when(is_word, F.col(c))).alias(c) for c in ("clean", "toxic")),
                   *(F.sum(F.when(~is_word, F.col(c))).alias(f"{c}_tokens") for c in ("clean", "toxic"))).head()
    if not n.toxic or not n.clean:
        return Model()
    prior = PRIOR_SHARE * (n.toxic + n.clean)
    own = F.lit(prior) * (F.col("toxic") + F.col("clean")) / (n.toxic + n.clean)
    odds = lambda y, total: F.log((y + own) / (total + prior - y - own))
    scored = counts.filter(is_word & (F.col("toxic") >= LEAST_TEXTS)).select(
        "word", "clean", "toxic", (odds(F.col("toxic"), n.toxic) - odds(F.col("clean"), n.clean)).alias("score"),
        (1 / (F.col("toxic") + own) + 1 / (F.col("clean") + own)).alias("variance"),
    )
    words = scored.filter(F.col("score") >= LEAST_Z * F.sqrt("variance")).collect()  # words of the bounded sample that stand out
    if not words:
        return Model()
    scores = {bytes(w.word): float(w.score) for w in words}
    rates = {c: min(0.5, (sum(w[c] for w in words) + 0.5) / (n[f"{c}_tokens"] + 1)) for c in ("clean", "toxic")}
    drift = min(-1e-4, math.log((1 - rates["toxic"]) / (1 - rates["clean"])))
    chances = [((w.clean + 0.5 / len(words)) / (n.clean_tokens + 1), w.score) for w in words]
    return Model(scores, drift, _decay(chances, drift))


def _decay(chances: list[tuple[float, float]], drift: float) -> float:
    """The positive root of E[exp(rate * score)] = 1 for the tokens of texts that are not toxic."""
    rest = 1 - sum(p for p, _ in chances)
    excess = lambda r: sum(p * math.exp(r * s) for p, s in chances) + rest * math.exp(r * drift) - 1
    low, high = 1e-6, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if excess(middle) > 0 else (middle, high)
    return max(low, 0.05)


def _calibrate(model: Model, texts: DataFrame) -> None:
    """Scale of the extreme-value law from texts that are not toxic; logistic curve of the statistic over binned counts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, toxic in zip(binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                n, parts = model.found(text)
                rows.append((toxic, n, [s for _, _, s in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.list_(pa.float64())))], ["toxic", "n", "found"]
            )

    rows = materialize(texts.select("text", "toxic").mapInArrow(measure, "toxic int, n bigint, found array<double>"), "measured")
    best = F.coalesce(F.array_max("found"), F.lit(0.0))
    clean = rows.filter("toxic = 0").agg(F.count("*").alias("k"), F.sum(F.col("n") * F.exp(-model.rate * best)).alias("s")).head()
    if clean.k and clean.s:
        model.scale = clean.k / clean.s  # the maximum-likelihood estimate
    grades = F.transform("found", lambda s: model.rate * s - F.log(model.scale * F.greatest("n", F.lit(1))))
    added = F.aggregate(F.filter(grades, lambda g: g > 0), F.lit(0.0), lambda a, g: a + g)
    x = F.when(F.size("found") == 0, FLOOR).otherwise(F.greatest(F.lit(FLOOR), F.coalesce(F.nullif(added, F.lit(0.0)), F.array_max(grades))))
    bins = rows.groupBy(F.round(x * 4).alias("x")).agg(F.sum("toxic").alias("y"), F.count("*").alias("n")).collect()  # quarter steps
    at = np.array([b.x / 4 for b in bins])
    y, n = np.array([float(b.y) for b in bins]), np.array([float(b.n) for b in bins])
    w = np.zeros(2)
    design = np.stack([np.ones_like(at), at / 4], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        ridge = np.diag([1e-3, 1e-3])
        w = w + np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge, design.T @ (y - n * p) - ridge @ w)
        w = np.clip(w, -60, 60)
    if w[1] > 0:
        model.slope, model.middle = float(w[1] / 4), float(-4 * w[0] / w[1])


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", cut: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` for each row of ``docs``.

    ``passages`` are the significant segments as first and last token, score and expected number of chance equals.  A
    NULL or empty text has no passage and the lowest score; ids may be NULL or repeated; without a model (no labelled
    rows of both kinds) every score is 0; an empty table gives no rows.
    """
    schema = "doc_id bigint, score double, passages array<struct<first:bigint,last:bigint,score:double,chance:double>>"
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())]))

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            scores, passages = [], []
            for body in binary(batch.column(1)):
                n, parts = model.found(body)
                scores.append(model.score(model.statistic(n, parts)))
                graded = [(a, b, s, model.scale * n * math.exp(-model.rate * s)) for a, b, s in parts]
                passages.append([dict(zip(("first", "last", "score", "chance"), g, strict=True)) for g in graded if g[3] <= SIGNIFICANT])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    found = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(grade, schema)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "passages")
