"""People and the titles they appear in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.titles import is_series, title_year, up_to_year
from millrace.plans.numbering import numbered


def parse_people(records: DataFrame, is_male: bool, value: str = "value") -> DataFrame:
    """``name, is_male, titles`` from blank-line separated, tab-separated records."""
    fields = F.transform(F.split(value, "\t"), lambda x: F.replace(x, F.lit("\n"), F.lit("")))
    return (
        records.select(F.filter(fields, lambda x: x != "").alias("fields"))
        .filter(F.size("fields") > 0)
        .select(
            F.get("fields", F.lit(0)).alias("name"),
            F.lit(is_male).alias("is_male"),
            F.slice("fields", F.lit(2), F.size("fields")).alias("titles"),
        )
    )


def drop_series(people: DataFrame) -> DataFrame:
    return people.withColumn("titles", F.filter("titles", lambda t: ~is_series(t)))


def titles_since(people: DataFrame, year: int = 2011) -> DataFrame:
    """Titles cut after their year, keeping those of ``year`` or later; no readable year means no."""
    cut = F.transform("titles", up_to_year)
    return people.withColumn("titles", F.filter(cut, lambda t: F.coalesce(title_year(t) >= year, F.lit(False))))


def drop_untitled(people: DataFrame) -> DataFrame:
    return people.filter(F.size("titles") > 0)


def clean_titles(people: DataFrame, year: int = 2011) -> DataFrame:
    return drop_untitled(titles_since(drop_series(people), year))


def people_union(male: DataFrame, female: DataFrame) -> DataFrame:
    """Both files in one table, told apart by ``is_male``."""
    return male.withColumn("is_male", F.lit(True)).unionByName(female.withColumn("is_male", F.lit(False)))


def with_surrogate_id(people: DataFrame, order: list[Column], name: str = "actor_id") -> DataFrame:
    """Dense ids from 0 in ``order``."""
    return numbered(people, order, start=-1, name=name)


def explode_titles(people: DataFrame) -> DataFrame:
    return people.select("actor_id", F.explode("titles").alias("movie"))


def bipartite_edges(people: DataFrame) -> DataFrame:
    """``actor_id, movie``, each pair once."""
    return explode_titles(people).distinct()


def find_root(people: DataFrame, name: str) -> int:
    """Id of the person called ``name``; the lowest one when several are."""
    row = people.filter(F.col("name") == name).agg(F.min("actor_id").alias("id")).first()
    if row is None or row["id"] is None:
        raise LookupError(f"nobody is called {name!r}")
    return row["id"]
