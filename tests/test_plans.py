"""What the plans of the registered queries must, and must not, contain."""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pytest

from millrace.operators import graph, reads, social, words
from millrace.plans.numbering import next_above, numbered
from millrace.plans.storage import checkpoint_folder, exists, materialize, release, scratch
from pyspark.sql import functions as F
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON = re.compile("BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|PythonRDD|ExistingRDD")
ONE_TASK_WINDOWS = {"contig_index", "contig_offsets", "variant_density", "variant_density_chunks", "region_pack", "region_assign",
                    "reads_per_region", "variants_per_region", "board_numbered", "people_ids", "people_at_distance", "density_rejects", "density_text", "separation_lines"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert not PYTHON.search(plan)
    assert "CartesianProduct" not in plan
    # One-row sides only: aggregates without keys.
    one_row = {"list_trim", "phone_stats", "separation_summary", "separation_lines"}
    assert name in one_row or "BroadcastNestedLoopJoin" not in plan
    # Windows in one task are over dictionaries and per-partition counts only.
    if name not in ONE_TASK_WINDOWS:
        assert not re.search(r"Window [^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)


def test_scans_read_only_what_they_use(spark):
    plan = _plan(QUERIES["variant_density"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert all("l_quantity" not in s and "l_shipdate" not in s for s in schemas) and schemas


def test_small_frontier_is_broadcast_and_large_one_is_not(spark):
    edges = materialize(spark.range(1000).select(F.col("id").alias("actor_id"), (F.col("id") % 10).alias("movie")), "edges")
    few = materialize(spark.range(3).select(F.col("id").alias("actor_id")), "few")
    assert "BroadcastHashJoin" in _plan(edges.join(few, "actor_id", "left_semi"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "BroadcastHashJoin" not in _plan(edges.join(few, "actor_id", "left_semi"))
        distances = graph.bfs_distance(edges, 0)
        assert distances.filter("distance = 1").count() == 99
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbering_of_one_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("hot")).alias("g"), (5000 - F.col("id")).alias("v"))
    got = numbered(df, [F.col("v")], within=["g"]).collect()
    for group in (None, "hot"):
        rows = sorted((r.v, r.row_no) for r in got if r.g == group)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))
    assert len(got) == 5000


def test_look_ups_read_each_row_once(spark):
    """No frame ends at the last row, as Spark reads such a frame again for every row."""
    sums = list(accumulate((i * 7919) % 13 for i in range(3000)))
    rows = spark.createDataFrame(list(enumerate(sums)), "place bigint, before bigint")
    found = next_above(rows, "before", 40)
    assert "unboundedfollowing" not in _plan(found).lower()
    want = {i: bisect_right(sums, s + 40) for i, s in enumerate(sums) if s + 40 < sums[-1]}
    assert {r.place: r.next for r in found.collect()} == want


def test_intermediate_tables_can_be_removed(spark):
    with scratch(spark):
        path = materialize(spark.range(3), "x").inputFiles()[0]
        assert exists(spark, path)
    assert not exists(spark, path)
    path = materialize(spark.range(3), "y").inputFiles()[0]
    assert path.startswith("file:") and checkpoint_folder(spark) in path
    release(spark)
    assert not exists(spark, path)


def QUERY_STATUSES(spark):
    from workload import tables

    return tables.statuses(spark, SF)


SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _split(df) -> bool:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split(skewed):
    spark = skewed
    lines = spark.range(0, 4000, 1, 8).select(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(" hub")).alias("line"))
    assert _split(words.word_freq(lines))
    edges = spark.range(0, 6000, 1, 8).select(F.col("id").alias("actor_id"), F.when(F.col("id") % 5 > 0, F.lit(1)).otherwise(F.col("id")).alias("movie"))
    assert _split(graph.costar_counts(edges))
    reads_ = spark.range(0, 6000, 1, 8).select(
        F.concat(F.lit("r"), "id").alias("name"), F.lit(1).alias("ref_index"), F.when(F.col("id") % 5 > 0, 7).otherwise(F.col("id")).alias("start"),
        F.lit("+").alias("strand"), F.col("id").alias("score"))
    assert _split(reads.mark_duplicates(reads_))


def test_rows_without_an_id_are_not_joined(skewed):
    board = skewed.range(3000).select(F.when(F.col("id") % 9 == 0, F.col("id")).alias("id"), F.lit(1).alias("n"))
    statuses = skewed.range(10).selectExpr(
        "id", "timestamp_seconds(id) AS ts", "'u' AS user", "'t' AS text", "'en' AS lang", "array('a') AS hashtags",
        "cast(null AS struct<id:bigint,user:string,text:string>) AS retweet_of")
    got = social.board_details(board, statuses)
    assert got.count() == 3000 and got.filter("user IS NOT NULL").count() == 2


def _exchanged_tables(plan: str) -> list[str]:
    """Tables that are read below an exchange of rows (not a broadcast)."""
    found, open_at = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        open_at = [d for d in open_at if d < depth]
        if re.search(r"\bExchange (hash|range|Round|Single)", line):
            open_at.append(depth)
        if "FileScan" in line and open_at:
            found.append(line)
    return found


def test_a_hop_moves_no_edges(spark):
    """Joins on person or title read bucketed edges in place, with a frontier too large to broadcast as well."""
    pairs = spark.range(2000).select(F.col("id").alias("actor_id"), (F.col("id") % 50).alias("movie"))
    edges = graph.clustered(pairs)
    frontier = materialize(spark.range(500).select(F.col("id").alias("actor_id")), "frontier")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        titles = edges.by_actor.join(frontier, "actor_id", "left_semi").select("movie")
        cast = edges.by_movie.join(frontier.withColumnRenamed("actor_id", "movie"), "movie", "left_semi").select("actor_id")
        for df, table in ((titles, "edges_by_actor"), (cast, "edges_by_movie")):
            plan = _plan(df)
            assert table in plan and not any(table in line for line in _exchanged_tables(plan))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert graph.bfs_distance(edges, 0).filter("distance = 1").count() == 39


def test_statuses_are_not_multiplied_before_the_joins(spark):
    """Windows of a status are made above both joins of the board."""
    rows = social.tweet_board(QUERY_STATUSES(spark), 7200, 600, ordered=False, details=False)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    made = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    joins = [i for i, x in enumerate(lines) if re.search(r"Join LeftOuter", x)]
    assert len(joins) == 2 and all(i > made and depth(lines[i]) > depth(lines[made]) for i in joins)


def test_one_long_key_is_scanned_by_many_tasks(skewed):
    """Islands and ranks of one sparse contig: sort partitions share its rows alike."""
    from millrace.plans.islands import merged

    df = skewed.range(0, 40_000, 1, 8).selectExpr("1 AS k", "id * 1000003 AS s", "id * 1000003 + if(id % 4 = 0, 1000003, 5) AS e")
    got = merged(df, "k", "s", "e", 0)
    assert got.count() == 30_000
    written = {f.rsplit("/", 1)[0] for f in got.inputFiles() if "/starts-" in f}
    sizes = [r["count"] for r in skewed.read.parquet(written.pop()).groupBy("_part").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 3 * 40_000 / len(sizes)
