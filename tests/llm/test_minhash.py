from __future__ import annotations

import random

import pytest

from millrace.llm import links, minhash
from millrace.plans.storage import materialize
from tests.llm.rows import DOCS, documents, prose, table


def _brute(rows, width, pct=80):
    """doc_id -> (size of the set, smallest id reachable), comparing all pairs."""
    sets = {}
    for doc, text in rows:
        words = [w for w in _lower(text or "").split()]
        k = min(width, len(words))
        sets.setdefault(doc, []).append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [(d, s) for d, many in sets.items() for s in many if s and d is not None]
    for i, (a, s) in enumerate(ids):
        for b, t in ids[:i]:
            if 100 * len(s & t) >= pct * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: ({len(s) for s in many}, find(d)) for d, many in sets.items() if d is not None}


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _check(spark, rows, width):
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).repartition(3)
    want = _brute(rows, width)
    got = minhash.near_duplicates(df, shingle=width).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            sizes, root = want[r.doc_id]
            assert r.n_shingles in sizes and (r.component_id, r.kept) == (root, r.doc_id == root)


@pytest.mark.parametrize("width", [4, 5])
def test_odd_rows(spark, width):
    _check(spark, [(r[0], r[1]) for r in documents()], width)


def test_group_of_near_copies_around_the_threshold(spark):
    """Copies with more and more words changed: chains of links, members unlike the centre, and some linked with nothing."""
    rng = random.Random(8)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice([0, 1, 2, 3, 4, 6, 8, 12])):
            words[at] = rng.choice(["Xa", "xb", f"x{i}"])
        rows.append((i * 3 % 150, " ".join(words[: rng.choice([120, 120, 110, 98])])))
    _check(spark, rows, 4)


def _family(rng, base, share):
    """The words with a share of them changed."""
    words = list(base)
    for at in rng.sample(range(len(words)), round(share * len(words))):
        words[at] = f"x{rng.randrange(10**6)}"
    return words


def test_a_bucket_is_compared_in_cells(spark, monkeypatch):
    """The same links whatever the cells are, and no join of a bucket's members with each other, which takes their square."""
    rng, plans = random.Random(5), {}
    base = prose(rng, 150).split()
    rows = []
    for i in range(0, 160, 2):
        words = _family(rng, base, rng.choice([0.02, 0.05, 0.1]))
        rows += [(i, " ".join(words)), (i + 1, " ".join(_family(rng, words, 0.02)))]

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, label)

    monkeypatch.setattr(minhash, "materialize", seen)
    _check(spark, rows, 4)
    assert "array_intersect" not in plans["more"]
    for cell in (300, 5000):
        monkeypatch.setattr(minhash, "CELL", cell)
        monkeypatch.setattr(minhash, "CELL_ROWS", 7)
        _check(spark, rows, 4)


def test_ids_of_several_texts_are_compared_by_each(spark):
    """Pairs of a family of unlike texts; each id has a long text of its own beside."""
    rng = random.Random(6)
    base = prose(rng, 150).split()
    rows = []
    for i in range(0, 60, 2):
        words = _family(rng, base, 0.06)
        rows += [(i, " ".join(words)), (i + 1, " ".join(_family(rng, words, 0.015)))]
        rows += [(k, prose(rng, 400)) for k in (i, i + 1)]
    _check(spark, rows, 4)


@pytest.mark.parametrize(("common", "block"), [(1, 1 << 22), (4, 100), (256, 7)])
def test_intersections(monkeypatch, common, block):
    import numpy as np

    monkeypatch.setattr(minhash, "COMMON", common)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(block)
    base = rng.integers(-(2**62), 2**62, 50)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(0, 50)), rng.integers(0, 40, rng.integers(1, 9))]) for _ in range(40)]
    ask, have = np.arange(3, 20), np.array([0, 5, 6, *range(15, 40)])
    blocks = minhash._intersections(np.concatenate(sets), np.array([len(s) for s in sets]), ask, have)
    got = {(a, b): n for x, y, common in blocks for a, row in zip(x, common) for b, n in zip(y, row, strict=True)}
    assert got == {(a, b): len(np.intersect1d(sets[a], sets[b])) for a in ask for b in have}


def test_signature_is_a_min_per_bin_and_fills_the_rest():
    import numpy as np

    probes = minhash._probes(16)
    for n in (1, 3, 200):
        s = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        got = minhash.densified(s, 16, probes)
        assert set(got) <= set(s)
        for b in range(16):
            own = s[(s >> np.uint64(60)) == b]
            assert not len(own) or got[b] == own.min()


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 240)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in links.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_clashing_columns_and_empty_table(spark):
    assert minhash.near_duplicates(table(spark, documents())).count() == len(documents())
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
