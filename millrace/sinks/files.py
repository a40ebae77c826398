"""File writers for the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_phone_index(index: DataFrame, out: str) -> None:
    index.write.mode("overwrite").parquet(out)


def freq_lines(freq: DataFrame) -> DataFrame:
    """``value``: nested lines of a ``word_freq`` result, ``word:n``, then ``<tab>pred:n`` for each predecessor, in order.

    One sort orders both kinds of line.
    """
    heads = freq.select("word", "n").distinct().withColumns({
        "pred": F.lit(None).cast("string"), "pred_n": F.lit(None).cast("bigint"), "level": F.lit(0),
    })
    rows = freq.filter(F.col("pred").isNotNull()).withColumn("level", F.lit(1))
    line = F.when(F.col("level") == 0, F.concat_ws(":", "word", "n")).otherwise(
        F.concat(F.lit("\t"), F.concat_ws(":", "pred", "pred_n"))
    )
    ordered = heads.unionByName(rows).orderBy(F.desc("n"), "word", "level", F.desc("pred_n"), "pred")
    return ordered.select(line.alias("value"))


def write_freq(freq: DataFrame, out: str) -> None:
    """The lines of ``freq_lines``; files in name order read as one text."""
    write_lines(freq_lines(freq), out)


def density_lines(density: DataFrame) -> DataFrame:
    """``value``: ``chrom, idx, region, n`` by contig and region, tab separated."""
    return density.orderBy("idx", "region").select(F.concat_ws("\t", "chrom", "idx", "region", "n").alias("value"))


def write_density(density: DataFrame, out: str) -> None:
    write_lines(density_lines(density), out)


def write_variants(ordered: DataFrame, out: str) -> None:
    """Raw lines of a ``variant_order`` result, in its order, without a header."""
    ordered.select(F.col("line").alias("value")).write.mode("overwrite").text(out)


def write_report(report: DataFrame, out: str) -> None:
    """Lines of a ``separation_report``."""
    report.select(F.col("line").alias("value")).write.mode("overwrite").text(out)


def to_bed(intervals: DataFrame, chrom: str = "chrom", bed_compat: bool = False) -> DataFrame:
    """1-based inclusive intervals as BED lines; ``bed_compat`` also lowers the end by one."""
    end = F.col("end") - 1 if bed_compat else F.col("end")
    return intervals.select(F.concat_ws("\t", chrom, F.col("start") - 1, end).alias("value"))


def to_region_strings(intervals: DataFrame, chrom: str = "chrom") -> DataFrame:
    return intervals.select(F.format_string("%s:%d-%d", F.col(chrom).cast("string"), "start", "end").alias("value"))


def write_lines(lines: DataFrame, out: str) -> None:
    lines.select("value").write.mode("overwrite").text(out)


def write_chunks(chunks: DataFrame, out: str) -> DataFrame:
    """Interleaved records as ``chunk=<n>`` folders in slot order; returns one marker per chunk (``chunk, value``).

    Chunks are bounded by their size in records, so one task may hold one whole.
    """
    chunks.repartition("chunk").sortWithinPartitions("chunk", "slot").write.mode("overwrite").partitionBy("chunk").parquet(out)
    return chunks.select("chunk").distinct().withColumn("value", F.format_string("fastq_%04d.fq", "chunk"))


def write_regions(reads: DataFrame, out: str) -> None:
    """Reads as ``region=<n>`` folders, sorted by contig and start inside each file.

    Rows are placed by ranges of the full order, so a region with most of the
    reads is written by many tasks, each with its own stretch of the genome.
    """
    order = ["region", "ref_index", "pos", "qname"]
    placed = reads.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.write.mode("overwrite").partitionBy("region").parquet(out)
