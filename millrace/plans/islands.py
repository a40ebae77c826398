"""Merging of overlapping or nearby intervals on data of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.storage import materialize


def merged(df: DataFrame, key: str, start: str, end: str, gap: int) -> DataFrame:
    """Union of the intervals of each ``key``; the next one joins while ``start <= furthest end + gap``.  Rows with a NULL are left out.

    A two-level scan.  Copies of a start collapse to one row, and rows are dealt to ranges of key and start over all tasks.
    Running maxima are taken inside each sort partition, and only two numbers for each partition and key travel on, both as
    running maxima over a table with one row for each of them: the furthest end seen so far, and the latest start that opened
    an island.  Partitions hold alike many rows however the starts are spread, so neither a long nor a sparse key meets in
    one task.
    """
    starts = (
        df.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
        .select(F.col(key).alias("_key"), F.col(start).cast("bigint").alias("_start"), F.col(end).cast("bigint").alias("_end"))
        .groupBy("_key", "_start")
        .agg(F.max("_end").alias("_end"))
        .repartitionByRange("_key", "_start")
        .withColumn("_part", F.spark_partition_id())
    )
    starts = materialize(starts, "starts")
    inside = Window.partitionBy("_key", "_part").orderBy("_start")

    reach = carried(starts, F.max("_end"), "_reach")
    seen = F.max("_end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    flagged = (
        starts.join(reach, same_part("_reach"))
        .withColumn("_seen", F.greatest(seen, "_reach"))
        .withColumn("_opens", F.when(F.col("_seen").isNull() | (F.col("_start") > F.col("_seen") + gap), F.col("_start")))
        .select("_key", "_part", "_start", "_end", "_opens")
    )

    opened = carried(flagged, F.max("_opens"), "_opened")
    here = F.max("_opens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        flagged.join(opened, same_part("_opened"))
        .withColumn("_island", F.coalesce(here, "_opened"))
        .groupBy("_key", "_island")
        .agg(F.max("_end").alias("_far"))
        .select(F.col("_key").alias(key), F.col("_island").alias(start), F.col("_far").alias(end))
    )


def same_part(name: str) -> Column:
    """The join of rows with what ``carried`` brings to their key and sort partition."""
    return (F.col("_key") == F.col(f"{name}_key")) & (F.col("_part") == F.col(f"{name}_part"))


def carried(rows: DataFrame, summary: Column, name: str, added: Callable[[str], Column] = F.max) -> DataFrame:
    """For each key and sort partition, ``summary`` of all earlier partitions of the key, put together by ``added``.

    There is one row for each key and partition it lies in: at most the keys plus the partitions.
    """
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("_key", "_part").agg(summary.alias("_summary")).select(
        F.col("_key").alias(f"{name}_key"), F.col("_part").alias(f"{name}_part"), added("_summary").over(earlier).alias(name)
    )
