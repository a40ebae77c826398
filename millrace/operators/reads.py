"""Aligned and raw sequencing reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.storage import materialize

CHUNK_RECORDS = 16_384
SANGER_LIMIT = 60
ILLUMINA_SHIFT = 31
REGION_BIN = 1_000_000

# The tags given to reads.
READ_GROUP = {"rgid": "GROUP1", "rglb": "LIB1", "rgpl": "ILLUMINA", "rgpu": "UNIT1", "rgsm": "SAMPLE1"}


def mapped_reads(reads: DataFrame, lo: int = 0, hi: int = 24) -> DataFrame:
    """Mapped reads with ``lo < ref_index <= hi``."""
    return reads.filter(~F.col("unmapped") & (F.col("ref_index") > lo) & (F.col("ref_index") <= hi))


def region_assign(reads: DataFrame, regions: DataFrame, offsets: DataFrame, n_regions: int, bin_size: int = REGION_BIN) -> DataFrame:
    """Adds ``region``: the one with ``start < position < end``, both strict, else ``n_regions - 1``.

    ``position`` is the read's place with contigs laid end to end.  Regions are
    cut into bins of ``bin_size`` and found by an equi join on the bin, so a read
    meets the regions of its own bin only, however many there are in all.  A read
    on a contig without an offset has no position and goes to the last region.
    """
    first, last = F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size)
    cut = regions.select(
        F.col("region").alias("_region"), F.col("start").alias("_from"), F.col("end").alias("_to"),
        F.explode(F.sequence(first, last)).alias("_bin"),
    )
    starts = offsets.select(F.col("idx").alias("ref_index"), F.col("offset").alias("_offset"))
    placed = reads.join(starts, "ref_index", "left").withColumn("_position", F.col("pos") + F.col("_offset"))
    inside = (
        (F.floor(F.col("_position") / bin_size) == F.col("_bin"))
        & (F.col("_position") > F.col("_from"))
        & (F.col("_position") < F.col("_to"))
    )
    return placed.join(cut, inside, "left").select(
        *reads.columns, F.coalesce("_region", F.lit(n_regions - 1)).cast("int").alias("region")
    )


def reads_per_region(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("region").agg(F.count("*").alias("n"))


def quality_encoding(reads: DataFrame, group: str = "grp", qual: str = "qual") -> DataFrame:
    """Adds ``illumina``, ``quals`` and ``bad``: qualities shifted by 31 where a group's largest exceeds 60.

    A read whose shifted qualities go below zero is flagged ``bad`` and keeps its numbers.  Reads without a group
    are a group of their own.
    """
    # The largest character decides.  The groups are written out, so that the reads
    # are joined to them by broadcast, unshuffled, if they are as few as usual.
    largest = F.ascii(F.array_max(F.split(qual, ""))) - 33
    encodings = reads.groupBy(F.col(group).alias("_group")).agg((F.max(largest) > SANGER_LIMIT).alias("illumina"))
    encodings = materialize(encodings, "encodings")
    shifted = F.when(F.col("illumina"), ILLUMINA_SHIFT).otherwise(0)
    return (
        reads.join(encodings, F.col(group).eqNullSafe(F.col("_group")), "left")
        .drop("_group")
        .withColumn("quals", F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33 - shifted))
        .withColumn("bad", F.coalesce(F.array_min("quals") < 0, F.lit(False)))
    )


def read_groups(reads: DataFrame, **tags: str) -> DataFrame:
    """Adds the read-group columns; keyword arguments replace the default values."""
    return reads.withColumns({name: F.lit(value) for name, value in {**READ_GROUP, **tags}.items()})


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Adds ``duplicate``: among reads of one ``ref_index, start, strand`` all but the best are duplicates.

    The best has the highest ``score`` (summed quality; none is lowest), then the lowest ``name``; reads that share the
    winning name are one template and stay.  A read without a place is no duplicate.  The best is a minimum, so a deep
    pile-up is reduced before it is shuffled; it is written, so that the join has plain shuffles, which split the pile-up.
    """
    place = ["ref_index", "start", "strand"]
    placed = F.col("ref_index").isNotNull() & F.col("start").isNotNull() & F.col("strand").isNotNull()
    rank = F.struct(F.col("score").isNull().alias("_none"), (-F.col("score")).alias("_rank"), F.col("name").alias("_best"))
    best = reads.filter(placed).groupBy(*place).agg(F.min(rank)["_best"].alias("_best"))
    best = materialize(best, "best")
    found = reads.filter(placed).join(best, place).select(*reads.columns, (~F.col("name").eqNullSafe(F.col("_best"))).alias("duplicate"))
    return found.unionByName(reads.filter(~placed).withColumn("duplicate", F.lit(False)))


def interleave_chunks(mates1: DataFrame, mates2: DataFrame, size: int = CHUNK_RECORDS) -> DataFrame:
    """``chunk, slot, pair, mate, ...``: two mate tables interleaved and cut into chunks of ``size`` records.

    ``pair`` is the record number from 0 in both; pairs that one side lacks are dropped.
    """
    shared = [c for c in mates1.columns if c != "pair"]
    side = lambda df, mate: df.select("pair", F.struct(F.lit(mate).alias("mate"), *shared).alias(f"_m{mate}"))
    both = side(mates1, 0).join(side(mates2, 1), "pair").select("pair", F.inline(F.array("_m0", "_m1")))
    slot = F.col("pair") * 2 + F.col("mate")
    return both.select(
        F.floor(slot / size).cast("int").alias("chunk"), (slot % size).cast("int").alias("slot"), "pair", "mate", *shared
    )


def chunk_id(names: DataFrame, name: str = "value") -> DataFrame:
    """Adds ``chunk``: the digits of a file name."""
    return names.withColumn("chunk", F.regexp_replace(name, "[^0-9]", "").try_cast("int"))
