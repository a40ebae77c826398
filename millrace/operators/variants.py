"""Genomic variants: density along the genome, load-balanced regions, call-set comparison.

Variants have ``chrom STRING, pos BIGINT, ref, alt STRING`` and optionally the raw ``line``.
Contigs have ``idx INT, name STRING, length BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.islands import carried, same_part
from millrace.plans.numbering import chained, next_above, running_sums
from millrace.plans.storage import materialize

REGION_SIZE = 1_000_000
CALL_KEY = ["chrom", "pos", "ref", "alt"]


def contig_index(contigs: DataFrame) -> DataFrame:
    """Numbered and X, Y, M contigs with a dense ``contig_no`` from 0 in dictionary order."""
    # A dictionary has one row per contig of one genome; a single task orders it.
    in_order = Window.orderBy("idx")
    return (
        contigs.filter(F.regexp_like("name", F.lit(r"^chr([\d]+|[MXY])$")))
        .withColumn("contig_no", (F.row_number().over(in_order) - 1).cast("int"))
        .select("contig_no", "name", "length")
    )


def _region_counts(variants: DataFrame, region_size: int) -> DataFrame:
    region = (F.floor(F.col("pos") / region_size) + 1).cast("int")
    return variants.groupBy("chrom", region.alias("region")).agg(F.count("*").alias("n"))


def variant_density(variants: DataFrame, index: DataFrame, region_size: int = REGION_SIZE, ordered: bool = True) -> DataFrame:
    """``chrom, idx, region, n``: variants per region (from 1) that has any, for contigs of ``index``.

    Counting comes first, so the lookup joins one row per region, not per variant.
    """
    counts = _region_counts(variants, region_size)
    density = counts.join(index.select(F.col("name").alias("chrom"), F.col("contig_no").alias("idx")), "chrom").select(
        "chrom", "idx", "region", "n"
    )
    return density.orderBy("idx", "region") if ordered else density


def density_rejects(variants: DataFrame, index: DataFrame) -> DataFrame:
    """``chrom, n``: variants on contigs that the dictionary lacks."""
    counts = variants.groupBy("chrom").agg(F.count("*").alias("n"))
    return counts.join(index.select(F.col("name").alias("chrom")), "chrom", "left_anti")


def variant_density_chunks(variants: DataFrame, index: DataFrame, size: int = REGION_SIZE) -> DataFrame:
    """``chrom, idx, chunk, n``: variants per run of ``size`` distinct positions, from 0, by position.

    Positions are sorted over all tasks; the rank of one is its rank in its sort partition plus the positions of its contig
    in earlier partitions, which come from a table with a row for each partition and contig.
    """
    sites = (
        variants.filter(F.col("pos").isNotNull())
        .groupBy(F.col("chrom").alias("_key"), "pos")
        .agg(F.count("*").alias("n"))
        .repartitionByRange("_key", "pos")
        .withColumn("_part", F.spark_partition_id())
    )
    sites = materialize(sites, "sites")
    before = carried(sites, F.count("*"), "_before", F.sum)
    inside = Window.partitionBy("_key", "_part").orderBy("pos")
    chunks = (
        sites.join(before, same_part("_before"))
        .withColumn("chunk", F.floor((F.coalesce("_before", F.lit(0)) + F.row_number().over(inside) - 1) / size).cast("int"))
        .groupBy(F.col("_key").alias("chrom"), "chunk")
        .agg(F.sum("n").alias("n"))
    )
    names = index.select(F.col("name").alias("chrom"), F.col("contig_no").alias("idx"))
    return chunks.join(names, "chrom").select("chrom", "idx", "chunk", "n").orderBy("idx", "chunk")


def contigs_present(density: DataFrame) -> DataFrame:
    return density.select("idx", "chrom").distinct()


def contig_offsets(present: DataFrame, contigs: DataFrame) -> DataFrame:
    """``idx, chrom, offset``: where each present contig starts when they are laid end to end by ``idx``."""
    # One row per contig of one genome; a single task adds them up.
    earlier = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    lengths = contigs.select(F.col("name").alias("chrom"), "length")
    return present.join(lengths, "chrom").select(
        "idx", "chrom", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    )


def variants_per_region(density: DataFrame, regions: int) -> DataFrame:
    """One row: ``variants`` and the share of each of ``regions``, rounded up."""
    return density.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("variants")).withColumn(
        "per_region", F.ceil(F.col("variants") / regions)
    )


def region_pack(density: DataFrame, regions: int, part_size: int = REGION_SIZE) -> DataFrame:
    """``region, start, end``: greedy packing of density rows into regions of about equal variant count.

    A region closes before the row that finds it above its share; what remains at the end is never closed.  With
    running sums, a region that starts at some row ends before the first row whose sum exceeds the start's by more
    than the share.  That row is looked up for every row at once, and the chain of looked-up rows from the first one
    on is followed by doubling, so the number of jobs grows with the logarithm of ``regions``.
    """
    total = density.agg(F.sum("n")).head()[0] or 0
    share = -(-int(total) // regions)
    counts = density.select("idx", "region", F.col("n").cast("bigint").alias("n"))
    rows = materialize(running_sums(counts, [F.col("idx"), F.col("region")], "n").select("place", "before"), "running")
    # A closed region holds more than a share, so there are fewer than `regions`.
    return chained(next_above(rows, "before", share), 0, regions).select(
        F.col("step").alias("region"), (F.col("place") * part_size).cast("double").alias("start"), (F.col("next") * part_size).cast("double").alias("end")).orderBy("region")


def chrom_number(variants: DataFrame) -> DataFrame:
    """Adds ``chrom_no``: X is 23, Y is 24, otherwise the digits of the name, else NULL."""
    digits = F.regexp_replace("chrom", "[^0-9]", "").try_cast("int")
    number = F.when(F.col("chrom") == "chrX", 23).when(F.col("chrom") == "chrY", 24).otherwise(digits)
    return variants.withColumn("chrom_no", number)


def variant_order(variants: DataFrame) -> DataFrame:
    """Variants of contigs 1 to 24 by contig and position."""
    ties = [c for c in ("line", "ref", "alt") if c in variants.columns]
    return chrom_number(variants).filter(F.col("chrom_no").between(1, 24)).orderBy("chrom_no", "pos", *ties)


def order_rejects(variants: DataFrame) -> DataFrame:
    """``chrom, n``: variants that ``variant_order`` leaves out, as their contig is none of 1 to 24."""
    outside = ~F.coalesce(F.col("chrom_no").between(1, 24), F.lit(False))
    return chrom_number(variants).filter(outside).groupBy("chrom").agg(F.count("*").alias("n"))


def variant_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct calls that both sets have."""
    return a.select(*CALL_KEY).intersect(b.select(*CALL_KEY))


def variant_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct calls of ``a`` that ``b`` lacks."""
    return a.select(*CALL_KEY).subtract(b.select(*CALL_KEY))


def variant_concordance(reference: DataFrame, calls: DataFrame) -> DataFrame:
    """One row ``total, matches, diff``: distinct reference calls, those found again, those not.

    Only contigs with ``chr`` in their name count.  Both sets go through one aggregation on the call key.
    """
    tagged = reference.select(*CALL_KEY, F.lit(True).alias("_expected")).unionByName(
        calls.select(*CALL_KEY, F.lit(False).alias("_expected"))
    )
    seen = tagged.filter(F.contains("chrom", F.lit("chr"))).groupBy(*CALL_KEY).agg(F.max("_expected").alias("expected"), F.min("_expected").alias("only_expected"))
    return seen.filter("expected").agg(
        F.count("*").alias("total"),
        F.count_if(~F.col("only_expected")).alias("matches"),
        F.count_if("only_expected").alias("diff"),
    )
