"""Row numbers over data of any size, without a window that holds a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.storage import materialize


def _sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """One global sort, written out, with the sort partition (``_part``) and an order inside it (``_slot``)."""
    slots = df.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_slot": F.monotonically_increasing_id()})
    return materialize(slots, "sorted")


def _before(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """``_part, <name>``: the sum of ``amount`` over earlier sort partitions, of which there are as many as tasks of the sort."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("_part").agg(amount.alias("_amount")).select(
        F.col("_part").alias("_own_part"), F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias(name)
    )


def running_sums(df: DataFrame, order: list[Column], value: str) -> DataFrame:
    """Adds ``place`` (from 0) and ``before``, the sum of ``value`` over all earlier rows in ``order``."""
    rows = _sorted(df, order)
    inside = Window.partitionBy("_part").orderBy("_slot")
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    here = rows.withColumns({"_place": F.row_number().over(inside) - 1, "_sum": F.coalesce(F.sum(value).over(ahead), F.lit(0))})
    starts = _before(rows, F.count("*"), "_rows").join(
        _before(rows, F.sum(value), "_total").withColumnRenamed("_own_part", "_same"), F.col("_own_part") == F.col("_same")
    )
    return here.join(starts, F.col("_part") == F.col("_own_part")).select(
        *df.columns, (F.col("_rows") + F.col("_place")).cast("bigint").alias("place"), (F.col("_total") + F.col("_sum")).cast("bigint").alias("before")
    )


def numbered(
    df: DataFrame,
    order: list[Column],
    within: list[str] | None = None,
    start: int = 0,
    name: str = "row_no",
) -> DataFrame:
    """Add ``name``: ``start + 1, start + 2, ...`` in ``order``, restarting for each value of ``within``.

    One global sort is written out together with each row's slot inside its sort
    partition.  The number of rows before each partition then comes from a table
    with one row per partition, and a hot group spans as many partitions as its
    rows need.  ``order`` must be a total order for the numbers to be reproducible.
    """
    within = within or []
    slots = _sorted(df, [*map(F.col, within), *order])
    # One row per sort partition: at most spark.sql.shuffle.partitions rows, whatever the data size.
    before = slots.groupBy("_part").agg(F.min("_slot").alias("_first_slot")).join(
        _before(slots, F.count("*"), "_rows"), F.col("_part") == F.col("_own_part")
    )
    placed = slots.join(F.broadcast(before.drop("_part")), F.col("_part") == F.col("_own_part")).withColumn(
        "_place", F.col("_rows") + F.col("_slot") - F.col("_first_slot")
    )
    if within:
        keys = [F.col(c).alias(f"_key_{i}") for i, c in enumerate(within)]
        first = placed.groupBy(*keys).agg(F.min("_place").alias("_first"))
        same = F.lit(True)
        for i, c in enumerate(within):
            same = same & placed[c].eqNullSafe(first[f"_key_{i}"])
        placed = placed.join(first, same).withColumn("_place", F.col("_place") - F.col("_first"))
    return placed.select(*df.columns, (F.col("_place") + F.lit(start + 1)).cast("bigint").alias(name))


def next_above(rows: DataFrame, key: str, ahead: int, place: str = "place") -> DataFrame:
    """``place, next``: for each row the first place whose ``key`` exceeds the row's own by more than ``ahead``.

    ``key`` does not fall as ``place`` rises.  Keys and the values to be exceeded go through one global sort, in which the
    answer of a row is the next key behind it; where a sort partition has none left, the first one of a later partition is.
    Rows that nothing exceeds are left out.  Windows run from behind, so that a row adds to the minimum of those after it;
    a frame up to the last row would be read again for every row.
    """
    keys = rows.select(F.col(key).alias("_key"), F.lit(0).alias("_kind"), F.col(place).alias("_place"))
    asked = rows.select((F.col(key) + ahead).alias("_key"), F.lit(1).alias("_kind"), F.col(place).alias("_place"))
    merged = _sorted(keys.unionByName(asked), [F.col("_key"), F.col("_kind"), F.col("_place")])
    found = F.when(F.col("_kind") == 0, F.col("_place"))
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = merged.groupBy("_part").agg(F.min(found).alias("_first")).select(F.col("_part").alias("_own_part"), F.min("_first").over(later).alias("_carried"))
    behind = Window.partitionBy("_part").orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    here = merged.withColumn("_here", F.min(found).over(behind)).filter("_kind = 1")
    answered = here.join(carried, F.col("_part") == F.col("_own_part")).select(F.col("_place").alias(place), F.coalesce("_here", "_carried").alias("next"))
    return answered.filter("next IS NOT NULL")


def chained(jumps: DataFrame, start: int, most: int, place: str = "place") -> DataFrame:
    """``place, next, step``: the rows that the chain of ``jumps`` (``place, next``) meets from ``start``, with their step from 0.

    Pointers double: round k joins the jumps of 2^k rows with themselves, and the rows met so far with them.  ``most`` is a
    bound of the chain's length, so there are log2(most) rounds whatever the number of rows.
    """
    spark = jumps.sparkSession
    jumps = doubled = materialize(jumps.select(place, "next"), "jumps")
    met = spark.range(1).select(F.lit(start).cast("bigint").alias(place), F.lit(0).alias("step"))
    for k in range(max(1, most).bit_length()):
        further = met.join(doubled, place).select(F.col("next").alias(place), (F.col("step") + (1 << k)).alias("step"))
        met = materialize(met.unionByName(further), "met")
        on = doubled.select(F.col(place).alias("next"), F.col("next").alias("_after"))
        doubled = materialize(doubled.join(on, "next").select(place, F.col("_after").alias("next")), "doubled")
    return met.join(jumps, place).select(place, "next", "step")
