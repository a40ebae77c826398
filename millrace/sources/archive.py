"""Web-archive text files and the manifests that list them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.segments import COMPLETE, scan_segments

# Fixed values of the file format: what opens a record, what ends its header.
RECORD_SEP = "WARC/1.0\r\n"
HEADER_END = "\r\n\r\n"


def wet_columns(value: Column) -> tuple[Column, Column]:
    """Target address (empty where there is none) and content of a raw record."""
    ends = F.locate(HEADER_END, value)
    header = F.when(ends > 0, F.substr(value, F.lit(1), ends)).otherwise(value)
    content = F.when(ends > 0, F.substr(value, ends + len(HEADER_END))).otherwise(F.lit(""))
    return F.regexp_extract(header, r"WARC-Target-URI: *([^\r\n]*)", 1), content


def parse_wet(raw: DataFrame) -> DataFrame:
    """``url, content`` (and ``file`` if present) of raw records in ``value``; records without a target are dropped."""
    url, content = wet_columns(F.col("value"))
    kept = ["file"] if "file" in raw.columns else []
    return raw.select(url.alias("url"), content.alias("content"), *kept).filter(F.col("url") != "")


def scan_wet(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``url, content, file`` of archive text files, gzip included: one task per compressed file.

    A file that is missing or broken stops the job; ``scan_manifest`` and ``millrace.operators.phones.crawl`` go on without it.
    """
    raw = spark.read.text(paths, lineSep=RECORD_SEP).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_wet(raw)


def split_manifest(uris: DataFrame, uri: str = "value") -> DataFrame:
    """``uri, status, path``: ``file`` and ``s3`` entries with a path to read, ``invalid`` and ``unknown`` ones without."""
    u = F.trim(F.col(uri))
    whole = F.regexp_like(u, F.lit(r"^s3://([^/]+)/(.+)"))
    status = (
        F.when(F.startswith(u, F.lit("file:")), "file")
        .when(F.startswith(u, F.lit("s3:/")), F.when(whole, "s3").otherwise("invalid"))
        .otherwise("unknown")
    )
    return uris.select(u.alias("uri"), status.alias("status")).withColumn(
        "path",
        F.when(F.col("status") == "file", F.col("uri")).when(F.col("status") == "s3", F.regexp_replace("uri", "^s3:", "s3a:")),
    )


def manifest_entries(spark: SparkSession, manifest: str) -> DataFrame:
    """``split_manifest`` of a file, without its empty lines."""
    return split_manifest(spark.read.text(manifest).filter(F.trim("value") != ""))


def listed_segments(entries: DataFrame) -> DataFrame:
    """The scan of all entries with a path, in the order of the list; see ``millrace.sources.segments``.

    The list of paths is what any file scan keeps on the driver.  Whether a segment is there is found by the task that reads it.
    """
    paths = [row["path"] for row in entries.filter(F.col("path").isNotNull()).select("path").toLocalIterator()]
    return scan_segments(entries.sparkSession, paths)


def entry_statuses(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """``uri, status, path`` with the status of the read (``complete``, ``broken``, ``missing``, ``unreachable``) where there was one."""
    read = segments.filter("status IS NOT NULL").groupBy("file").agg(F.max("status").alias("_read"))
    return entries.join(read, F.col("path") == F.col("file"), "left").select("uri", F.coalesce("_read", "status").alias("status"), "path")


def scan_manifest(spark: SparkSession, manifest: str) -> tuple[DataFrame, DataFrame]:
    """The records of all segments that a manifest lists, and its entries that were not read whole (``uri, status, path``).

    Records before the point where a segment breaks off are kept, and its entry is ``broken``.  Either result reads the
    segments when it is used; ``millrace.operators.phones.crawl`` gets both out of one read.
    """
    entries = manifest_entries(spark, manifest)
    scan = listed_segments(entries)
    rejects = entry_statuses(entries, scan).filter(F.col("status") != COMPLETE)
    return parse_wet(scan.filter("value IS NOT NULL").select("value", "file")), rejects
