"""Phone numbers in crawled text.

Input: records with ``url`` and ``content``; see ``millrace.sources.archive``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.phones import AREA_CODES_3, AREA_CODES_4, national_numbers, old_style_numbers
from millrace.plans.storage import materialize
from millrace.sources.archive import wet_columns
from millrace.sources.segments import BROKEN, COMPLETE, MISSING, UNREACHABLE


def phone_hits(records: DataFrame, extra_prefixes: Iterable[str] = ()) -> DataFrame:
    """``num, url``: one row per occurrence of a number with a valid area code."""
    codes = [*AREA_CODES_3, *AREA_CODES_4, *extra_prefixes]
    return records.select(F.explode(national_numbers(F.col("content"), codes)).alias("num"), "url")


def crawl(segments: DataFrame, extra_prefixes: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``num, url`` of every hit, and a row for each segment with its status, counts and seconds, out of one read.

    ``segments`` is the output of ``scan_segments``.  The read is written out: numbers and statuses only, no texts.
    """
    codes = [*AREA_CODES_3, *AREA_CODES_4, *extra_prefixes]
    url, content = wet_columns(F.col("value"))
    found = F.when(url != "", national_numbers(content, codes))
    closing = ["file", "status", "records", "bytes", "fetch_s", "decompress_s", "parse_s"]
    rows = segments.select(*closing, url.alias("url"), F.explode_outer(found).alias("num"))
    rows = materialize(rows.filter("num IS NOT NULL OR status IS NOT NULL"), "crawl")
    return rows.filter("num IS NOT NULL").select("num", "url"), rows.filter("status IS NOT NULL").select(*closing)


def segment_totals(segments: DataFrame) -> DataFrame:
    """One row: segments by status, records, bytes, and the seconds that tasks spent on each step."""
    by_status = [F.count_if(F.col("status") == s).alias(f"{s}_segments") for s in (COMPLETE, BROKEN, MISSING, UNREACHABLE)]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "bytes", "fetch_s", "decompress_s", "parse_s")]
    return segments.filter("status IS NOT NULL").agg(F.count("*").alias("segments"), *by_status, *sums)


def phone_legacy(records: DataFrame) -> DataFrame:
    """``num, url`` by the older pattern, each number once per record."""
    return records.select(F.explode(old_style_numbers(F.col("content"))).alias("num"), "url")


def valid_prefix(nums: DataFrame, prefixes: DataFrame, num: str = "num") -> DataFrame:
    """Rows whose number opens with one of ``prefixes`` (``prefix STRING`` of three or four characters)."""
    codes = prefixes.select("prefix").distinct()
    three = codes.withColumnRenamed("prefix", "_three")
    four = codes.withColumnRenamed("prefix", "_four")
    return (
        nums.join(three, F.substring(F.col(num), 1, 3) == F.col("_three"), "left")
        .join(four, F.substring(F.col(num), 1, 4) == F.col("_four"), "left")
        .filter(F.col("_three").isNotNull() | F.col("_four").isNotNull())
        .drop("_three", "_four")
    )


def phone_index(hits: DataFrame) -> DataFrame:
    """``num, url, times``: every page of a number and how often it is there.

    A row is a page, so the rows of a placeholder number that fills a large share of a crawl are spread like all others.
    """
    return hits.groupBy("num", "url").agg(F.count("*").alias("times"))


def phone_stats(hits: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row: unique numbers, hits, and the segments listed, processed and failed.

    ``manifest`` is the output of ``split_manifest``, or of ``entry_statuses`` once the segments were read.
    """
    found = hits.groupBy("num").agg(F.count("*").alias("times")).agg(
        F.count("*").alias("unique_numbers"), F.coalesce(F.sum("times"), F.lit(0)).alias("hits")
    )
    failed = F.count_if(F.col("status").isin("invalid", "unknown", BROKEN, MISSING, UNREACHABLE))
    listed = manifest.agg(
        F.count("*").alias("segments"), (F.count("*") - failed).alias("processed_segments"), failed.alias("failed_segments")
    )
    # Two one-row tables.
    return found.withColumn("_one", F.lit(1)).join(listed.withColumn("_one", F.lit(1)), "_one").drop("_one")
