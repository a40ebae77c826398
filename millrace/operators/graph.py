"""Degrees of separation over a bipartite person-title graph.

``edges`` has ``actor_id, movie``.  People are neighbours when they share a
title; the person-to-person graph is never built, because a title with a cast
of k would turn into k squared rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.numbering import numbered
from millrace.plans.storage import bucketed, materialize

UNREACHED = 100
MAX_HOPS = 6


@dataclass
class Clustered:
    """Edges written twice, bucketed by person and by title, so that joins on either move only the other side."""

    by_actor: DataFrame
    by_movie: DataFrame


def clustered(edges: DataFrame, buckets: int | None = None) -> Clustered:
    """Write ``edges`` in both clusterings, in as many buckets as a shuffle has partitions unless told otherwise."""
    spark = edges.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_actor = bucketed(edges.select("actor_id", "movie"), "actor_id", count, "edges_by_actor")
    return Clustered(by_actor, bucketed(by_actor, "movie", count, "edges_by_movie"))


def bfs_distance(edges: DataFrame | Clustered, root: int, max_hops: int = MAX_HOPS) -> DataFrame:
    """``actor_id, distance`` for everybody; people beyond ``max_hops`` get 100.

    A hop is two semi joins: the titles of the frontier, then the casts of those titles, minus people already reached.
    Edges are clustered for both joins, so a hop moves the frontier and its titles, never the edges.  A title comes up for
    the people who found it and once more for its cast.  Each frontier is written out, so that plans stay short, a lost
    executor costs one hop at most, and a small frontier is broadcast on its true size while a large one is shuffled.
    """
    edges = edges if isinstance(edges, Clustered) else clustered(edges)
    spark = edges.by_actor.sparkSession
    seed = spark.range(1).select(F.lit(root).cast("bigint").alias("actor_id"), F.lit(0).alias("distance"))
    frontier = materialize(seed, "hop")
    reached = [frontier]
    for hop in range(1, max_hops + 1):
        titles = edges.by_actor.join(frontier, "actor_id", "left_semi").select("movie").distinct()
        cast = edges.by_movie.join(titles, "movie", "left_semi").select("actor_id").distinct()
        unseen = cast.join(_all(reached), "actor_id", "left_anti")
        frontier = materialize(unseen.withColumn("distance", F.lit(hop)), "hop")
        if frontier.isEmpty():
            break
        reached.append(frontier)
    people = edges.by_actor.select("actor_id").distinct()
    return people.join(_all(reached), "actor_id", "left").select(
        "actor_id", F.coalesce("distance", F.lit(UNREACHED)).alias("distance")
    )


def costar_pairs(edges: DataFrame, actors: DataFrame) -> DataFrame:
    """``actor_id, costar_id, movie`` for the chosen ``actors`` (``actor_id``): one row per shared title."""
    chosen = edges.join(actors.select("actor_id").distinct(), "actor_id", "left_semi")
    others = edges.withColumnRenamed("actor_id", "costar_id")
    return drop_self_pairs(others.join(chosen, "movie")).select("actor_id", "costar_id", "movie")


def drop_self_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("actor_id") != F.col("costar_id"))


def costar_counts(edges: DataFrame) -> DataFrame:
    """``actor_id, titles, shared``: how many rows the title self join holds for each person.

    A person in a title with a cast of k has k - 1 such rows there, so counting
    the casts gives the numbers without pairing anyone.
    """
    edges = materialize(edges.select("actor_id", "movie"), "edges")
    casts = materialize(edges.groupBy("movie").agg((F.count("*") - 1).alias("others")), "casts")
    return edges.join(casts, "movie").groupBy("actor_id").agg(F.count("*").alias("titles"), F.sum("others").alias("shared"))


def distance_histogram(people: DataFrame, distances: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """``distance, males, females`` for each distance from 1 to ``max_hops``, zeros included."""
    counts = (
        distances.filter(F.col("distance").between(1, max_hops))
        .join(people.select("actor_id", "is_male"), "actor_id")
        .groupBy("distance")
        .agg(F.count_if("is_male").alias("males"), F.count_if(~F.col("is_male")).alias("females"))
    )
    hops = people.sparkSession.range(1, max_hops + 1).select(F.col("id").cast("int").alias("distance"))
    return hops.join(counts, "distance", "left").na.fill(0, ["males", "females"])


def separation_summary(people: DataFrame, distances: DataFrame, edges: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """One row of totals: people by gender with whole percents, titles, people within reach and their ratios."""
    totals = people.agg(
        F.count("*").alias("people"), F.count_if("is_male").alias("males"), F.count_if(~F.col("is_male")).alias("females")
    )
    near = distance_histogram(people, distances, max_hops).agg(
        F.sum("males").alias("near_males"), F.sum("females").alias("near_females")
    )
    movies = edges.select("movie").distinct().agg(F.count("*").alias("movies"))
    one = F.lit(1).alias("_one")
    row = (
        totals.select("*", one).join(near.select("*", one), "_one").join(movies.select("*", one), "_one").drop("_one")
    )
    whole = lambda part: F.expr(f"({part} * 100) div nullif(people, 0)").alias(f"{part}_percent")
    share = lambda part, base: F.round(F.try_divide(part, base), 6)
    return row.select(
        "people",
        "males",
        whole("males"),
        "females",
        whole("females"),
        "movies",
        (F.col("near_males") + F.col("near_females")).alias("near"),
        "near_males",
        "near_females",
        share(F.col("near_males") + F.col("near_females"), F.col("people")).alias("near_ratio"),
        share(F.col("near_males"), F.col("males")).alias("near_males_ratio"),
        share(F.col("near_females"), F.col("females")).alias("near_females_ratio"),
    )


def people_at_distance(people: DataFrame, distances: DataFrame, distance: int = MAX_HOPS) -> DataFrame:
    """``is_male, place, name, actor_id`` of the people at one distance, by name, numbered within gender."""
    chosen = people.select("actor_id", "name", "is_male").join(
        distances.filter(F.col("distance") == distance), "actor_id", "left_semi"
    )
    return numbered(chosen, [F.col("name"), F.col("actor_id")], within=["is_male"], name="place").select(
        "is_male", "place", "name", "actor_id"
    )


def separation_report(people: DataFrame, distances: DataFrame, edges: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """``section, place, line``: the printed report, in that order."""
    summary = separation_summary(people, distances, edges, max_hops)
    ratio = lambda part, base: F.coalesce(
        F.try_divide(part.cast("float"), F.col(base).cast("float")).cast("float").cast("string"), F.lit("NaN")
    )
    reach = lambda who, part, base: F.concat(
        F.format_string(f"Total number of {who} from distance 1 to {max_hops} = %d, ratio = ", part), ratio(part, base)
    )
    heading = F.format_string(
        "Total number of actors = %d, out of which %d (%d%%) are males while %d (%d%%) are females.",
        "people", "males", "males_percent", "females", "females_percent",
    )
    totals = _report_lines({
        (0, 1): heading,
        (0, 2): F.format_string("Total number of movies = %d", "movies"),
        (0, 3): F.lit(""),
        (2, 0): F.lit(""),
        (2, 1): reach("actors", F.col("near"), "people"),
        (2, 2): reach("male actors", F.col("near_males"), "males"),
        (2, 3): reach("female actors (actresses)", F.col("near_females"), "females"),
        (3, -1): F.lit(""),
        (3, 0): F.lit(f"List of male actors at distance {max_hops}:"),
        (4, -1): F.lit(""),
        (4, 0): F.lit(f"List of female actors (actresses) at distance {max_hops}:"),
    })
    percent = lambda part, base: F.format_string("%.1f", F.coalesce(F.try_divide(F.col(part) * 100.0, F.col(base)), F.lit(0.0)))
    everybody = summary.select(F.col("males").alias("all_males"), F.col("females").alias("all_females"), F.lit(1).alias("_one"))
    per_hop = (
        distance_histogram(people, distances, max_hops)
        .withColumn("_one", F.lit(1))
        .join(everybody, "_one")
        .select(
            F.lit(1).alias("section"),
            F.col("distance").cast("bigint").alias("place"),
            F.concat(
                F.format_string("There are %d (", "males"), percent("males", "all_males"),
                F.format_string("%%) actors and %d (", "females"), percent("females", "all_females"),
                F.format_string("%%) actresses at distance %d", "distance"),
            ).alias("line"),
        )
    )
    names = people_at_distance(people, distances, max_hops).select(
        F.when(F.col("is_male"), 3).otherwise(4).alias("section"), "place", F.format_string("%d. %s", "place", "name").alias("line")
    )
    return summary.select(totals).unionByName(per_hop).unionByName(names).orderBy("section", "place")


def _report_lines(lines: dict) -> Column:
    rows = [
        F.struct(F.lit(section).alias("section"), F.lit(place).cast("bigint").alias("place"), line.alias("line"))
        for (section, place), line in lines.items()
    ]
    return F.inline(F.array(*rows))


def _all(frontiers: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frontiers)
