from __future__ import annotations

import random
import zlib

from millrace.llm import toxicity
from tests.llm.rows import DOCS, documents, prose, table

BAD = ["idiota", "scumo", "trasho"]


def _corpus(n=600, seed=9):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(30, 120)).split()
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(BAD) + rng.choice(["", ".", "!"]) for _ in range(rng.randint(2, 5))]
        rows.append((i, " ".join(words).capitalize(), "aa", "host", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_segments_equal_brute_force():
    """Maximal segments: repeatedly the best-scoring run, then the same to its left and right."""

    def brute(scores, base=0):
        best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
        if best is None or best[0] <= 1e-12:
            return []
        _, _, _, a, b = best
        return brute(scores[:a], base) + [(base + a, base + b - 1, round(best[0], 6))] + brute(scores[b:], base + b)

    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 14)
        hits = [(i, rng.choice([1.3, 2.1, 4.7])) for i in range(n) if rng.random() < 0.35]
        drift = -rng.choice([0.31, 0.77, 1.9])
        scores = [drift] * n
        for i, s in hits:
            scores[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(hits, drift)]
        assert got == brute(scores)


def test_held_out_documents_and_odd_rows(spark):
    rows, labels = _corpus()
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.learnt(docs, marks)
    assert {b.encode() for b in BAD} <= set(model.scores)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    truth = {d: t for d, _, t in labels}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 for d, r in got.items())
    held = [d for d, r in got.items() if r.held_out]
    assert sum(got[d].predicted != truth[d] for d in held) <= 0.03 * len(held)
    assert all(bool(r.passages) == bool(truth[d]) for d, r in got.items() if r.predicted == truth[d])

    odd = documents() + [(900, "x " * 3000 + "idiota scumo idiota", None, None, None)]
    scored = toxicity.scored(table(spark, odd), model).collect()
    assert len(scored) == len(odd) and all(r.predicted == (r.doc_id == 900) for r in scored)
    place = next(r.passages for r in scored if r.doc_id == 900)
    assert [(p.first, p.last) for p in place] == [(3000, 3002)]


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = _corpus(300)
    docs = spark.createDataFrame(rows, DOCS)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 3 == 1 else t) for d, q, t in labels]
    one, two = (toxicity.learnt(docs, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flipped))
    assert one.scores == two.scores and one.middle == two.middle


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = spark.createDataFrame(documents(), DOCS)
    model = toxicity.learnt(docs, none)
    assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.0}
    assert toxicity.scored(spark.createDataFrame([], DOCS), model).count() == 0


def test_all_passages_count(spark):
    """Several passages that stand out give a higher statistic than the best of them alone."""
    model = toxicity.Model(scores={b"bad": 3.0}, drift=-0.5, rate=1.0, scale=0.01, slope=1.0, middle=5.0)
    one, two = b"x " * 50 + b"bad bad bad", b"bad bad bad " + b"x " * 50 + b"bad bad bad"
    (n, a), (m, b) = model.found(one), model.found(two)
    assert (len(a), len(b)) == (1, 2) and model.statistic(m, b) > 1.8 * model.statistic(n, a) > 0
    weak = model.found(b"x " * 5000 + b"bad")
    assert model.statistic(*weak) == 3.0 - __import__("math").log(0.01 * 5001) < 0


def test_labels_of_equal_texts(spark):
    """Equal texts count once and as toxic if any is, whichever row comes first."""
    rows, labels = _corpus(300)
    twice = rows + [(1000 + r[0], *r[1:]) for r in rows]
    marks = labels + [(1000 + d, q, 0) for d, q, _ in labels]
    models = [toxicity.learnt(spark.createDataFrame(x, DOCS).repartition(k), spark.createDataFrame(y, "doc_id bigint, quality int, toxic int"))
              for x, y, k in ((twice, marks, 2), (twice[::-1], marks[::-1], 5))]
    assert models[0].scores == models[1].scores and abs(models[0].middle - models[1].middle) < 1e-9
