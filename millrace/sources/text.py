"""Line and record scans of text files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scan_lines(spark: SparkSession, path: str | list[str], min_partitions: int | None = None) -> DataFrame:
    """``value``: one row per line.

    ``min_partitions`` cuts the files into that many splits at least, as far as their format and size allow; nothing is
    shuffled.
    """
    if min_partitions:
        spark.conf.set("spark.sql.files.minPartitionNum", str(min_partitions))
    return spark.read.text(path)


def scan_records(spark: SparkSession, path: str | list[str], sep: str = "\n\n") -> DataFrame:
    """``value``: one row per record between separators; empty records are left out."""
    return spark.read.text(path, lineSep=sep).filter(F.trim(F.replace("value", F.lit("\n"), F.lit(" "))) != "")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line_no, value``: lines with their number in the file, from 1.

    Numbers come from the block a line was read from: its rank inside the block
    plus the lines of earlier blocks of the file.  Both depend on the block
    alone, so a retried or moved task gives the same numbers; a line whose block
    is missing from the counts stops the job.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        lines.groupBy("file", "block")
        .agg(F.count("*").alias("_lines"))
        .select("file", "block", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    )
    ranked = lines.mapInArrow(_rank_in_block, "value string, file string, block bigint, rank bigint")
    placed = ranked.join(before, ["file", "block"], "left")
    known = F.when(F.col("_before").isNull(), F.raise_error(F.lit("input files changed while being numbered"))).otherwise(F.col("_before"))
    return placed.select("file", (known + F.col("rank") + 1).cast("bigint").alias("line_no"), "value")


def _rank_in_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks count on across batches until the file or the block changes."""
    open_block, rank = None, 0
    for batch in batches:
        file, block = batch.column(1), batch.column(2)
        ranks = np.empty(batch.num_rows, dtype=np.int64)
        for lo, hi in _runs(file, block):
            here = (file[lo].as_py(), block[lo].as_py())
            first = rank if here == open_block else 0
            ranks[lo:hi] = np.arange(first, first + hi - lo)
            open_block, rank = here, first + hi - lo
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks)], ["value", "file", "block", "rank"])


def _runs(file: pa.Array, block: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal (file, block) in a batch."""
    if len(file) == 0:
        return
    names = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = block.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((names[1:] != names[:-1]) | (starts[1:] != starts[:-1])) + 1
    edges = [0, *cuts.tolist(), len(names)]
    yield from zip(edges[:-1], edges[1:], strict=True)


def trim_list_file(lines: DataFrame) -> DataFrame:
    """Records of a list file (``line_no, value``): what lies between its header and its footer.

    The header is the first line reading ``NameTitles`` without its blanks, and the
    rule under it; the footer is the first later line longer than three that opens with ``---``.
    Two aggregates to one row each find them.
    """
    stripped = F.regexp_replace("value", r"\s", "")
    header = lines.filter(stripped == "NameTitles").agg(F.min("line_no").alias("_header"))
    body = lines.join(F.broadcast(header), F.col("line_no") > F.col("_header") + 1)
    # A line as the file holds it ends in a line feed, which counts as its fourth character.
    footer = body.filter(F.startswith("value", F.lit("---"))).agg(F.coalesce(F.min("line_no"), F.lit(2**62)).alias("_footer"))
    return body.join(F.broadcast(footer), F.col("line_no") < F.col("_footer")).select("line_no", "value")
