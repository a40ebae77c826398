from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, people
from millrace.sources.text import numbered_lines, scan_records, trim_list_file


def test_parse_and_clean(spark, tmp_path):
    text = 'A, B\t"Tv" (2012)\n\t\t\tFilm (2012/I)  [X]\n\t\t\tOld (2009)\n\t\t\tQ (????)\n\t\t\tP (Part) (2015)\n\nC\t\t"S" (2013)\n\n\n\n'
    (tmp_path / "p.list").write_text(text)
    raw = people.parse_people(scan_records(spark, str(tmp_path / "p.list")), True)
    assert [(r.name, r.is_male, len(r.titles)) for r in raw.collect()] == [("A, B", True, 5), ("C", True, 1)]
    kept = people.clean_titles(raw).collect()
    assert [(r.name, r.titles) for r in kept] == [("A, B", ["Film (2012/I)"])]


def test_trim_list(spark, tmp_path):
    body = ["Copyright", "x", "Name  \t Titles", "----  ------", "A\tF (2012)", "", "B\tG (2013)", "-----", "tail", "Name Titles", "z"]
    (tmp_path / "x.list").write_text("\n".join(body) + "\n")
    lines = numbered_lines(spark, str(tmp_path / "x.list"))
    assert [r.value for r in trim_list_file(lines).orderBy("line_no").collect()] == body[4:7]


def test_surrogate_ids_and_root(spark):
    rows = [(f"n{i:04d}", i % 3 == 0) for i in range(1000)]
    random.Random(1).shuffle(rows)
    ids = people.with_surrogate_id(spark.createDataFrame(rows, "name string, is_male boolean"), [F.desc("is_male"), F.col("name")])
    got = [(r.actor_id, r.name) for r in ids.orderBy("actor_id").collect()]
    assert got == list(enumerate(n for n, m in sorted(rows, key=lambda r: (not r[1], r[0]))))
    assert people.find_root(ids, "n0003") == 1
    with pytest.raises(LookupError):
        people.find_root(ids, "nobody")


def _neighbours(pairs):
    casts = {}
    for a, m in pairs:
        casts.setdefault(m, set()).add(a)
    return lambda a: {b for x, m in pairs if x == a for b in casts[m]}


def _by_adjacency(pairs, root, hops=6):
    """Distances by adjacency lists, the second way to get them."""
    near, distance, frontier = _neighbours(pairs), {root: 0}, {root}
    for hop in range(1, hops + 1):
        frontier = {b for a in frontier for b in near(a)} - set(distance)
        distance |= dict.fromkeys(frontier, hop)
    return {a: distance.get(a, 100) for a, _ in pairs}


def test_distances_two_ways(spark):
    rng = random.Random(3)
    pairs = sorted({(rng.randrange(120), rng.randrange(150)) for _ in range(230)} | {(i, 1000 + i) for i in range(120)}
                   | {(200 + i, 2000 + i // 2) for i in range(20)} | {(200 + i, 3000 + (i + 1) // 2) for i in range(20)})
    edges = spark.createDataFrame(pairs, "actor_id bigint, movie bigint")
    busiest = max(range(120), key=lambda a: sum(x == a for x, _ in pairs))
    for root in (busiest, 200):
        got = {r.actor_id: r.distance for r in graph.bfs_distance(edges, root).collect()}
        assert got == _by_adjacency(pairs, root)
        assert 100 in got.values() and max(v for v in got.values() if v < 100) >= 4


def test_costars(spark):
    pairs = [(1, 10), (2, 10), (3, 10), (1, 11), (2, 11), (4, 12)]
    edges = spark.createDataFrame(pairs, "actor_id bigint, movie bigint")
    chosen = spark.createDataFrame([(1,)], "actor_id bigint")
    assert sorted(tuple(r) for r in graph.costar_pairs(edges, chosen).collect()) == [(1, 2, 10), (1, 2, 11), (1, 3, 10)]
    assert {r.actor_id: (r.titles, r.shared) for r in graph.costar_counts(edges).collect()} == {1: (2, 3), 2: (2, 3), 3: (1, 2), 4: (1, 0)}


def test_report(spark):
    who = spark.createDataFrame([(0, "Root", True), (1, "Al", True), (2, "Bo", False), (3, "Cy", False)], "actor_id bigint, name string, is_male boolean")
    edges = spark.createDataFrame([(0, 1), (1, 1), (1, 2), (2, 2), (3, 9)], "actor_id bigint, movie bigint")
    report = graph.separation_report(who, graph.bfs_distance(edges, 0), edges, max_hops=2)
    assert [r.line for r in report.collect()] == [
        "Total number of actors = 4, out of which 2 (50%) are males while 2 (50%) are females.",
        "Total number of movies = 3",
        "",
        "There are 1 (50.0%) actors and 0 (0.0%) actresses at distance 1",
        "There are 0 (0.0%) actors and 1 (50.0%) actresses at distance 2",
        "",
        "Total number of actors from distance 1 to 2 = 2, ratio = 0.5",
        "Total number of male actors from distance 1 to 2 = 1, ratio = 0.5",
        "Total number of female actors (actresses) from distance 1 to 2 = 1, ratio = 0.5",
        "",
        "List of male actors at distance 2:",
        "",
        "List of female actors (actresses) at distance 2:",
        "1. Bo",
    ]
