"""Genomic intervals: coverage, merging, overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.islands import merged
from millrace.plans.storage import materialize

COVER_SLACK = 51
OVERLAP_BIN = 4_096
FANOUT = 8  # from the width of a level's bins to that of the next
LEVELS = 16  # the widest holds any interval of 64-bit places


def covered_intervals(reads: DataFrame, slack: int = COVER_SLACK) -> DataFrame:
    """``ref_index, start, end``: reads joined while ``start <= end so far + slack``."""
    return merged(reads, "ref_index", "start", "end", slack)


def merge_overlap(intervals: DataFrame, overlap: int, chrom: str = "chrom") -> DataFrame:
    """``chrom, start, end``: widened to the left by ``overlap`` (not below 1) and joined while overlapping.

    Contig names are compared, and returned, in lower case.
    """
    key = F.lower(chrom) if dict(intervals.dtypes)[chrom] == "string" else F.col(chrom)
    joined = merged(intervals.withColumn(chrom, key), chrom, "start", "end", overlap - 1)
    return joined.withColumn("start", F.greatest(F.col("start") - overlap, F.lit(1)).cast("bigint"))


def interval_intersect(a: DataFrame, b: DataFrame, key: str = "chrom", bin_width: int = OVERLAP_BIN) -> DataFrame:
    """``key, start, end``: the shared part of every overlapping pair of ``[start, end)`` intervals.

    Bins have levels, each ``FANOUT`` times as wide as the one below.  An interval is at home on the first level with bins as
    long as itself, where it lies in two bins at most; it also takes its bins on those wider levels that are a home on the
    other side.  A pair meets on the wider one of its two homes, and is kept in the bin that holds the start of its overlap,
    so it appears once.  However long an interval is, it makes a handful of rows.
    """
    sides = {name: materialize(_at_home(df, key, bin_width), f"intervals_{name}") for name, df in (("a", a), ("b", b))}
    homes = {name: sorted(r["_home"] for r in df.select("_home").distinct().collect()) for name, df in sides.items()}  # 64 at most
    start, end = F.greatest("_a_start", "_b_start"), F.least("_a_end", "_b_end")
    # A pair of one level is at home there on both sides, any other on one; wider levels of both meet nothing new.
    meet = (F.col("_level") == F.greatest("_a_home", "_b_home")) & (start < end) & (F.floor(start / _width(F.col("_level"), bin_width)) == F.col("_bin"))
    left, right = _in_bins(sides["a"], "a", key, homes["b"], bin_width), _in_bins(sides["b"], "b", key, homes["a"], bin_width)
    return left.join(right, [key, "_level", "_bin"]).filter(meet).select(key, start.alias("start"), end.alias("end"))


def _width(level: Column, bin_width: int) -> Column:
    return F.lit(bin_width).cast("bigint") * F.pow(F.lit(FANOUT), level).cast("bigint")


def _at_home(df: DataFrame, key: str, bin_width: int) -> DataFrame:
    """``key, start, end, _home``: the intervals that are not empty, with the first level whose bins are as long."""
    length = F.col("end") - F.col("start")
    levels = F.array(*(F.lit(bin_width * FANOUT**k) for k in range(LEVELS)))
    shorter = F.size(F.filter(levels, lambda w: w < length))
    kept = df.select(key, F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"))
    return kept.filter(F.col("start") < F.col("end")).withColumn("_home", shorter)


def _in_bins(df: DataFrame, side: str, key: str, others: list[int], bin_width: int) -> DataFrame:
    """A row for each bin of an interval on its home level, and on the wider ones that are homes of the other side."""
    own = F.array_distinct(F.concat(F.array("_home"), F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > F.col("_home"))))
    levels = df.withColumn("_level", F.explode(own))
    width = _width(F.col("_level"), bin_width)
    bins = F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))
    return levels.select(key, "_level", F.explode(bins).alias("_bin"), F.col("start").alias(f"_{side}_start"), F.col("end").alias(f"_{side}_end"),
                         F.col("_home").alias(f"_{side}_home"))


def half_open(intervals: DataFrame) -> DataFrame:
    """1-based inclusive intervals as 0-based half-open ones."""
    return intervals.withColumn("start", F.col("start") - 1)
