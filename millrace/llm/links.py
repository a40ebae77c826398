"""Connected components of a graph given as edges, on data of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.storage import materialize

ROUNDS = 60  # twice the logarithm of any number of nodes that a cluster can hold


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of undirected edges ``a, b``.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one, then its
    smaller neighbours.  Both shrink the graph to stars around the smallest nodes.  A step is one aggregation, which
    combines before its shuffle, and one plain join, which adaptive execution splits at a hub with very many
    neighbours.  Every round is written below the checkpoint folder.  Self loops and repeated edges are ignored; no
    edges give no rows.
    """
    now = materialize(_oriented(edges), "edges")
    seen = _print(now)
    for _ in range(ROUNDS):
        if not seen[0]:
            break
        now = materialize(_small_star(materialize(_large_star(now), "edges")), "edges")
        was, seen = seen, _print(now)
        if seen == was:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger node ``a`` to the smaller node ``b``."""
    pair = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.filter("a <> b").distinct()


def _large_star(now: DataFrame) -> DataFrame:
    both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    # a's neighbours above a go to the smallest neighbour: those are the rows of `now` with a below them.
    moved = now.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a")
    return _oriented(moved.select(F.col("v").alias("a"), F.col("m").alias("b")))


def _small_star(now: DataFrame) -> DataFrame:
    least = materialize(now.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = now.join(least, "a")
    return _oriented(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))))


def _print(now: DataFrame) -> tuple:
    row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
    return row[0], row[1]
