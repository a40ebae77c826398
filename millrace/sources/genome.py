"""Genome file scans: variants, sequence dictionaries, aligned reads, FASTQ pairs, density tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.text import numbered_lines

DENSITY_SCHEMA = "chrom string, idx int, region int, n bigint"
UNMAPPED_BIT = 4
REVERSE_BIT = 16


def parse_variants(lines: DataFrame, value: str = "value") -> DataFrame:
    """``chrom, pos, id, ref, alt, line`` of tab-separated lines; ``#`` lines and lines without a position are left out."""
    cell = lambda i: F.get(F.split(value, "\t", 6), F.lit(i))
    return (
        lines.filter(~F.startswith(value, F.lit("#")))
        .select(
            cell(0).alias("chrom"), cell(1).try_cast("bigint").alias("pos"), cell(2).alias("id"),
            cell(3).alias("ref"), cell(4).alias("alt"), F.col(value).alias("line"),
        )
        .filter(F.col("pos").isNotNull())
    )


def scan_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_variants(spark.read.text(path))


def scan_dict(spark: SparkSession, path: str) -> DataFrame:
    """``idx, name, length`` of a sequence dictionary, in file order from 0; the first line is its header."""
    fields = F.split("value", r"\s+")
    after_colon = lambda i: F.regexp_replace(F.get(fields, F.lit(i)), "^[^:]*:", "")
    return (
        numbered_lines(spark, path)
        .filter((F.col("line_no") > 1) & (F.size(fields) > 2))
        .select(
            (F.col("line_no") - 2).cast("int").alias("idx"),
            after_colon(1).alias("name"),
            F.coalesce(after_colon(2).try_cast("bigint"), F.lit(0)).alias("length"),
        )
    )


def cigar_span(cigar: Column) -> Column:
    """Reference bases an alignment covers: the summed lengths of its M, D, N, = and X steps."""
    steps = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def parse_sam(lines: DataFrame, contigs: DataFrame | None = None, value: str = "value") -> DataFrame:
    """Alignment lines as columns; header lines and lines of fewer than eleven fields are left out.

    With ``contigs``, ``ref_index`` is the contig's ``idx`` (NULL for a name the dictionary lacks).
    """
    fields = F.split(value, "\t")
    text = lambda i: F.get("_f", F.lit(i))
    number = lambda i, kind: text(i).try_cast(kind)
    kept = ["file"] if "file" in lines.columns else []
    reads = (
        lines.filter(~F.startswith(value, F.lit("@")))
        .select(fields.alias("_f"), *kept)
        .filter(F.size("_f") >= 11)
        .select(
            text(0).alias("qname"), number(1, "int").alias("flag"), text(2).alias("rname"),
            number(3, "bigint").alias("pos"), number(4, "int").alias("mapq"), text(5).alias("cigar"),
            text(6).alias("rnext"), number(7, "bigint").alias("pnext"), number(8, "int").alias("tlen"),
            text(9).alias("seq"), text(10).alias("qual"), *kept,
        )
        .withColumns({
            "align_end": F.col("pos") + cigar_span(F.col("cigar")) - 1,
            "unmapped": F.col("flag").bitwiseAND(UNMAPPED_BIT) != 0,
            "strand": F.when(F.col("flag").bitwiseAND(REVERSE_BIT) != 0, "-").otherwise("+"),
        })
    )
    if contigs is None:
        return reads
    index = contigs.select(F.col("name").alias("rname"), F.col("idx").alias("ref_index"))
    return reads.join(index, "rname", "left")


def scan_sam(spark: SparkSession, path: str | list[str], contigs: DataFrame | None = None) -> DataFrame:
    """Aligned reads of SAM text files or a folder of them, with the file each came from."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_sam(lines, contigs)


def scan_fastq_pair(spark: SparkSession, path1: str, path2: str) -> tuple[DataFrame, DataFrame]:
    """Two tables ``pair, name, seq, qual``, record numbers from 0; a record cut short is left out."""
    return _scan_fastq(spark, path1), _scan_fastq(spark, path2)


def _scan_fastq(spark: SparkSession, path: str) -> DataFrame:
    lines = numbered_lines(spark, path).withColumn("_at", F.col("line_no") - 1)
    field = lambda i: F.max(F.when(F.col("_at") % 4 == i, F.col("value")))
    return (
        lines.groupBy(F.floor(F.col("_at") / 4).alias("pair"))
        .agg(F.substring(field(0), 2, 2**31 - 1).alias("name"), field(1).alias("seq"), field(3).alias("qual"))
        .filter(F.col("qual").isNotNull())
    )


def read_density(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DENSITY_SCHEMA).csv(path, sep="\t")
