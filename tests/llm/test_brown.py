from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import brown
from tests.llm.rows import DOCS, documents, table


def _words(text):
    return [w.decode() for w in brown.words_of((text or "").encode())] + ["\0"]


def _hash(word):
    value = brown.xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64 if value >> 63 else 0)


def _likelihood(bigrams, of, classes):
    table = np.zeros((classes, classes))
    np.add.at(table, (of[:, None], of[None, :]), bigrams)
    f = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return f(table.ravel()) - f(table.sum(0)) - f(table.sum(1))


def test_a_batch_looks_up_its_new_words_only(monkeypatch):
    rng = random.Random(6)
    words = [("w%d" % k).encode() for k in range(3000)]
    heads = brown.Heads(np.array([_hash(w) for w in words[:1500]], np.int64))
    asked, plain = [], brown.Heads.of
    monkeypatch.setattr(brown.Heads, "of", lambda self, hashes, otherwise: asked.extend(hashes) or plain(self, hashes, otherwise))
    units = brown.Units(heads)
    for _ in range(20):
        units.of(b" ".join(rng.choices(words, k=300)))
        units.units()
    assert len(asked) == len(units)
    assert units.hashed().tolist() == units.hashes
    assert units.units().tolist() == plain(heads, np.array(units.hashes, np.int64), brown.HEADS + np.array(units.forms, np.int64)).tolist()


def test_words_of_many_texts_are_cut_at_once():
    """The words of each text by itself, and a distinct word is looked up once."""
    odd = [None, "", " ", "A b", " a  b\n", "\x0b\x0ca\x1cb\x85c\r\td", "É é\xa0x", "a" * 20 + " a\0 \0"]
    texts = odd + [r[1] for r in documents()] + ["ab cd " * 500, "AB cd"]
    for column in (pa.array(texts, pa.string()), pa.array(texts, pa.large_string()), pa.array(["x y", *texts], pa.string())[1:]):
        asked = []

        class Counted(brown.Words):
            def __getitem__(self, word):
                asked.append(word)
                return super().__getitem__(word)

        words, plain = Counted(), brown.Words()
        codes, ends = words.all_of(column)
        names, each = list(words), [brown.words_of(None if t is None else t.encode()) for t in texts]
        assert [[names[k] for k in c] for c in np.split(codes, ends)] == [*each, []]
        assert sorted(asked) == sorted({w for ws in each for w in ws})
        assert [(words.hashes[words[w]], words.forms[words[w]]) for w in names] == [(plain.hashes[plain[w]], plain.forms[plain[w]]) for w in names]


def test_logarithms_are_taken_once_for_a_count(monkeypatch):
    """Many units with the same small counts need hardly more logarithms than one for each of their cells."""
    rng, taken, plain = np.random.default_rng(2), [], brown._xlogx
    table = rng.integers(1, 1000, (64, 64)) * 1.0
    r, l = ((rng.random((256, 64)) < 0.3) * 1.0 for _ in range(2))
    a = rng.integers(0, 63, 256)
    monkeypatch.setattr(brown, "_xlogx", lambda x: taken.append(x.size) or plain(x))
    brown.best_classes(table + 256, r, l, np.zeros(256), a)
    assert sum(taken) < 256 * 64 * 10


def test_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(3)
    bigrams = rng.integers(0, 5, (9, 9)).astype(float)
    classes, of = 4, np.array([0, 1, 2, 0, 1, 2, 0, 1, 3])
    for u in range(8):
        member = np.zeros((9, classes))
        others = np.arange(9) != u
        member[np.arange(9)[others], of[others]] = 1
        table = member.T @ bigrams @ member
        gains = brown._gains(table, bigrams[u] @ member, bigrams[:, u] @ member, bigrams[u, u])
        want = []
        for c in range(classes):
            moved = of.copy()
            moved[u] = c
            want.append(_likelihood(bigrams, moved, classes))
        assert np.allclose(gains - gains[0], np.array(want) - want[0])


def test_exchange_finds_the_classes_that_made_the_text():
    rng = np.random.default_rng(5)
    units, truth = 31, np.arange(30) % 3
    bigrams = np.zeros((units, units))
    u = 0
    for _ in range(30_000):
        v = int(rng.integers(0, 10)) * 3 + (truth[u] + 1) % 3  # the next class is certain
        bigrams[u, v] += 1
        u = v
    of = brown.exchanged(bigrams, classes=4)
    assert all(len({of[i] for i in range(30) if truth[i] == c}) == 1 for c in range(3)) and of[30] == 3


@pytest.mark.parametrize("seed", range(20))
def test_the_best_class_is_that_of_the_likelihood(seed):
    rng = np.random.default_rng(seed)
    bigrams = rng.integers(0, 3, (9, 9)) * rng.integers(0, 2, (9, 9)) * 1.0
    of = np.array([0, 1, 2, 0, 1, 2, 0, 1, 3])
    member = np.eye(4)[of]
    table = member.T @ bigrams @ member
    got = brown.best_classes(table, (bigrams @ member)[:8], (bigrams.T @ member)[:8], np.diag(bigrams)[:8], of[:8])
    for u in range(8):
        likelihoods = [_likelihood(bigrams, np.where(np.arange(9) == u, c, of), 4) for c in range(3)]
        assert likelihoods[got[u]] >= max(likelihoods) - 1e-9
    assert np.isclose(brown.likelihood(table), _likelihood(bigrams, of, 4))


def test_all_frequent_words_are_clustered_one_by_one(spark):
    """Four kinds of 700 words that end alike; the next word's kind is certain, so no class should hold two kinds."""
    rng = random.Random(13)
    kinds = [[f"{k * 700 + i:05d}zzz" for i in range(700)] for k in range(4)]
    rows = [(i, " ".join(rng.choice(kinds[(i + k) % 4]) for k in range(120)), None, None, None) for i in range(500)]
    model = brown.learnt(spark.createDataFrame(rows, DOCS).repartition(3).select("text"))
    frequent = {r.h: r.n for r in model.vocab.collect() if r.n >= brown.LEAST and r.h != int(brown.END)}
    assert len(frequent) > 2700 and len(model.heads) == len(frequent)
    held = Counter()
    for k, words in enumerate(kinds):
        for h in (brown.xxhash.xxh3_64_intdigest(w.encode()) for w in words):
            h = h - (1 << 64) if h >> 63 else h
            if h in frequent:
                held[model.classes[model.heads.get(h, 0)], k] += 1
    largest = {c: max(held[c, k] for k in range(4)) for c, _ in held}
    assert sum(largest.values()) > 0.99 * len(frequent)


def test_pairs_of_units_are_exact(spark, monkeypatch):
    """Over several flushes and buckets."""
    monkeypatch.setattr(brown, "PAIRS", 50)
    monkeypatch.setattr(brown, "BUCKET", 100)
    texts = [t for _, t, *_ in documents()]
    model = brown.learnt(table(spark, documents()).select("text"))
    size, h = model.heads.size, brown.Words()
    unit = lambda w: model.heads.get(h.hashes[h[w]], brown.HEADS + h.forms[h[w]])
    want = Counter()
    for t in texts:
        chain = [size - 1, *(unit(w) for w in brown.words_of((t or "").encode())), size - 1]
        want.update(zip(chain[:-1], chain[1:], strict=True))
    for side in (0, 1):
        got = Counter()
        for r in brown.unit_pairs(table(spark, documents()).select("text"), model.heads, 5000).collect():
            for key, n in zip(np.frombuffer(r[f"keys{side}"], np.int64).tolist(), np.frombuffer(r[f"n{side}"], np.int64).tolist(), strict=True):
                got[divmod(key, size)[:: -1 if side else 1]] += n
        assert got == want


@pytest.mark.parametrize("counted", [5, 1 << 17])
def test_counts_and_base_scores_are_exact(spark, monkeypatch, counted):
    """``counted`` words travel to the tasks, the rest is joined; small vocabularies in the tasks are dealt with as well."""
    monkeypatch.setattr(brown, "COUNTED", counted)
    monkeypatch.setattr(brown, "MOST", 40)
    rows = documents()
    got = brown.score_documents(table(spark, rows)).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter(w for r in rows if not held(r[0]) for w in _words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for r in rows:
        ws = _words(r[1])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        want[r[0], held(r[0]), len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_of_the_next_word_add_up_to_one(spark):
    """All known words and one unseen word in each class, after a given class."""
    docs = spark.createDataFrame([(i, t, None, None, None) for i, (_, t, *_) in enumerate(documents()[:20])], DOCS)
    model = brown.learnt(docs.select("text"))
    of = {r.h: (r.n, model.classes[model.heads.get(r.h, brown.HEADS + r.form)] if r.h != int(brown.END) else model.classes[-1]) for r in model.vocab.collect()}
    for before in range(3):
        total = sum(10 ** (model.transition[before, c] + math.log10(n + brown.ALPHA) - model.weight[c]) for n, c in of.values())
        total += sum(10 ** (model.transition[before, c] + math.log10(brown.ALPHA) - model.weight[c]) for c in range(brown.CLASSES))
        assert abs(total - 1) < 1e-6


def test_context_beats_the_base_on_held_out_text(spark):
    rng = random.Random(11)
    kinds = [[a + b + c for a in x for b in "aeiou" for c in "xyz"] for x in ("bcd", "fgh", "klm")]
    rows = [(i, " ".join(rng.choice(kinds[k % 3]) for k in range(60)), None, None, None) for i in range(300)]
    got = brown.score_documents(spark.createDataFrame(rows, DOCS).repartition(3)).filter("held_out").collect()
    assert len(got) > 20 and sum(r.score for r in got) > 0.85 * sum(r.base_score for r in got)


def test_no_documents(spark):
    assert brown.score_documents(spark.createDataFrame([], DOCS)).count() == 0
    one = brown.score_documents(spark.createDataFrame([(None, None, None, None, None)], DOCS)).head()
    assert (one.n_tokens, one.n_known, one.train_tokens) == (1, 1, 1)
