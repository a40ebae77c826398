"""Hard negatives against brute force over all rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, positives=5, count=3, low=50, high=95, every=50):
    kept = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, v, c) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j, d) for b, (j, w, d) in enumerate(kept) if b != a)
        for p, j, _ in [r for r in scored if r[2] == c][:positives]:
            near = [(n, k) for n, k, d in scored if d != c and low * -p <= 100 * -n <= high * -p][:count]
            out.update((i, j, r, k, -p, -n) for r, (n, k) in enumerate(near, 1))
    return out


def found(df):
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def vectors(n=600, dim=6, seed=1):
    """Clusters with an odd row of every kind, a vector that a third of all rows share, ties and repeated rows."""
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.4) for _ in range(dim)]
    rows = []
    for i in range(n):
        base = hot if i % 3 == 0 else [rng.gauss(i % 4, 0.5) - 1.5 for _ in range(dim)]
        rows.append((i, list(base), i % 5))
    rows += [(50, list(hot), 0), (50, list(hot), 0), (7, rows[7][1], 2)]
    rows += [(None, [0.1] * dim, 1), (n, None, 1), (n + 50, [0.1] * dim, None), (n + 100, [0.1, None] + [0.0] * (dim - 2), 1)]
    rows += [(n + 150, [float("nan")] + [0.0] * (dim - 1), 1), (n + 200, [float("inf")] + [0.0] * (dim - 1), 1), (n + 250, [], 3), (n + 300, [0.5], 3)]
    return rows


@pytest.fixture(autouse=True)
def small(monkeypatch):
    for name, value in (("SHARD_ROWS", 64), ("ANCHORS", 4), ("CELL_ROWS", 8), ("STEP", 16)):
        monkeypatch.setattr(negatives, name, value)


def test_all_rows_against_brute_force(spark):
    rows = vectors()
    clash = {c: F.lit("x") for c in ("row", "shard", "anchor", "place", "score", "rank", "v", "slots")}
    got = found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(clash)))
    assert got == brute(rows) and len(got) > 30


def test_shards_without_a_chance_are_not_searched(spark):
    """Well apart clusters: bounds close most shards, and the result stays whole."""
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.02) + (4.0 if k == i % 6 else 0.0) for k in range(6)], i // 6 % 3) for i in range(900)]
    index = negatives.indexed(negatives.usable(spark.createDataFrame(rows, SCHEMA)))
    ask = index.rows.filter("vec_id % 50 = 0").selectExpr(
        "row AS anchor", "label", "v", "array(0) AS slots", "array(4000000L) AS los", "array(9000000L) AS his", "5 AS want", "true AS same")
    shards = len(set(index.books.shards.tolist()))
    later = negatives._routed(ask, index.books, False)
    assert shards > 10 and later.count() < 18 * (shards - 1) / 2
    assert found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_cells_come_by_falling_bounds():
    import numpy as np

    rng = np.random.default_rng(3)
    cells = sorted({(int(a), int(b)) for a, b in rng.integers(0, 7, (25, 2))})
    c1, c2 = (np.array(x) for x in zip(*cells, strict=True))
    b1, b2 = rng.normal(size=7), rng.normal(size=7)
    seen = list(negatives._visit(None, None, c1, c2, b1, b2))
    assert sorted(k for k, _ in seen) == list(range(len(cells)))
    assert [b for _, b in seen] == sorted((b for _, b in seen), reverse=True)
    assert all(abs(b - b1[c1[k]] - b2[c2[k]]) < 1e-12 for k, b in seen)


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5]) for _ in range(4)], i % 3) for i in range(120)]
    assert found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert negatives.indexed(negatives.usable(spark.createDataFrame(rows, SCHEMA))).books.exact == "float64"
    rows = [(i, [rng.uniform(-1, 1) * 1e6 for _ in range(2)], i % 3) for i in range(101)]
    assert found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_few_and_no_rows(spark):
    empty = negatives.hard_negatives(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).count() == 0
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2), (3, [-1.0], 1), (4, [0.0], 2)]
    assert found(negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows) == Counter({(0, 1, 1, 2, 65536, 256 * 179): 1})
