"""Streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATUS_SCHEMA = (
    "id bigint, ts timestamp, user string, text string, lang string, hashtags array<string>,"
    " retweet_of struct<id:bigint,user:string,text:string>"
)


def stream_statuses(
    spark: SparkSession, folder: str, schema: str = STATUS_SCHEMA, fmt: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """Statuses arriving as files; any other source with these columns serves as well."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def stream_markers(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``value``: the lines of marker files, each the name of a finished chunk."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)
