from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import sharding
from tests.llm.rows import DOCS, documents, table


def _least_capacity(sizes, shards):
    """Brute force: the smallest largest part of a contiguous partition."""
    best = {0: 0}
    for _ in range(shards):
        best = {j: min(max(best[i], sum(sizes[i:j])) for i in best if i <= j) for j in range(len(sizes) + 1)}
    return best[len(sizes)]


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_capacity_is_the_least_and_kept(spark, shards):
    rng = random.Random(shards)
    for sizes in ([rng.randint(1, 40) for _ in range(12)], [1, 1, 50, 1, 1, 1], [7], [3] * 9):
        rows = spark.createDataFrame(list(enumerate(sizes)), "atom int, size bigint")
        got = sharding.minimax_cuts(rows, shards).head()
        assert got.capacity == _least_capacity(sizes, shards)
        edges = [0, *got.cuts, len(sizes)]
        assert len(got.cuts) <= shards - 1 and got.cuts == sorted(set(got.cuts))
        assert all(sum(sizes[a:b]) <= got.capacity for a, b in zip(edges, edges[1:], strict=False))
        if len(sizes) >= shards:
            assert len(got.cuts) >= shards - 2  # one huge group does not leave the others empty


def test_odd_rows(spark):
    rows = documents()
    got = sharding.shard_documents(table(spark, rows), shards=4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, homes = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())


def test_empty_table(spark):
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_written_shards(spark, tmp_path):
    rows = documents()
    sharding.write_shards(spark.createDataFrame(rows, DOCS), str(tmp_path / "s"), shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}
