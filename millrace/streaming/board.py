"""The hashtag board over a stream, on Spark's own watermark and state store.

Two windowed aggregations of the same stream (retweets by status, uses by hashtag) close their windows at the same
watermark and are joined on window and hashtag, all in append mode.  A window's rows leave in one batch, once; Spark keeps
the counts, drops what is late, and recovers both from the checkpoint.  Each batch's windows are then limited, numbered on
from the last window written, and stored as folders of their own, so a batch that runs again writes the same again.

Layout below ``out``: ``board/window_end_s=<n>`` (Parquet), ``report/window_end_s=<n>`` (text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import social
from millrace.plans.storage import exists, materialize, partition_values, scratch

# Fixed values of the report's text.
DOUBLE, SINGLE, DOTS = "=" * 50, "-" * 50, "." * 50


def closed_boards(statuses: DataFrame, window: int = social.WINDOW, slide: int = social.SLIDE, delay: int = 0) -> DataFrame:
    """The rows of ``tweet_board``, with user and text, as a stream: a window's rows come when the watermark passes its end.

    The watermark is ``delay`` seconds behind the latest event of earlier batches.  An id is one status: where it comes
    twice in a window, the least hashtag, user and text count.  Statuses without an id are kept apart by their content.
    """
    spoken = social.filter_lang(statuses.withWatermark("ts", f"{delay} seconds"))
    tag = F.get("hashtags", F.lit(0))
    own = social.originals(spoken).select("ts", "id", F.struct(tag.alias("tag"), "user", "text").alias("status"), "hashtags")
    span = F.window("ts", f"{window} seconds", f"{slide} seconds").alias("window")

    shared = social.retweets(spoken).select("ts", F.col("retweet_of.id").alias("id"), F.lit(None).cast("struct<tag:string,user:string,text:string>").alias("status"))
    nameless = F.when(F.col("id").isNull(), F.col("status")).alias("content")
    rows = own.select("ts", "id", "status").unionByName(shared).groupBy(span, "id", nameless).agg(
        F.min("status").alias("status"), F.count_if(F.col("status").isNull()).alias("shares"), F.count("status").alias("own")
    ).filter("own > 0")

    # A status without a hashtag has a key of its own, so that it finds one row on the other side as well, of no uses.
    key_of = lambda named, i: F.coalesce(named, F.concat(F.lit("\u0000"), F.coalesce(i.cast("string"), F.lit(""))))
    used = F.when(F.size("hashtags") > 0, F.transform("hashtags", lambda t: F.struct(t.alias("key"), F.lit(1).alias("n")))).otherwise(
        F.array(F.struct(key_of(tag, F.col("id")).alias("key"), F.lit(0).alias("n"))))
    uses = own.select("ts", F.explode(used).alias("use")).groupBy(span, F.col("use.key").alias("key")).agg(F.sum("use.n").alias("uses"))

    rows = rows.select(F.col("window").alias("row_window"), key_of(F.col("status.tag"), F.col("id")).alias("row_key"), "id", "status", "shares")
    joined = rows.join(uses, F.expr("row_window = window AND row_key = key"))
    return social.drop_unique_unshared(joined.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), F.col("uses").alias("hashtagcount"),
        F.coalesce("status.tag", F.lit(social.NO_TAG)).alias("hashtag"), "id", (F.col("shares") + 1).alias("retweets"),
        F.col("status.user").alias("user"), F.col("status.text").alias("text"),
    ))


def stream_board(
    statuses: DataFrame,
    out: str,
    checkpoint: str,
    window: int = social.WINDOW,
    slide: int = social.SLIDE,
    delay: int = 0,
    top: int = 3,
    interval: str | None = None,
) -> StreamingQuery:
    """Start writing the numbered board and the report of each closed window; without ``interval`` it stops when all input is read.

    Rows for windows that an earlier batch has closed are late: dropped by Spark, and counted in its progress (``Progress.late``).
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        write_windows(batch, out, top)

    writer = closed_boards(statuses, window, slide, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(process)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def write_windows(rows: DataFrame, out: str, top: int = 3) -> None:
    """Limit, number and write the windows of ``rows``, replacing those windows only.

    Numbers go on from the last window that ends before them, so earlier windows must have been written.
    """
    spark = rows.sparkSession
    with scratch(spark):
        rows = materialize(rows, "closed")  # the batch is used several times; its state must be read once
        first = rows.agg(F.min(F.unix_seconds("window_end")).alias("s")).head()["s"]
        if first is None:
            return
        limited = social.board_topn(rows, top)
        numbers = social.number_rows(limited, last_number(spark, out, first)).select("window_start", "id", "hashtag", "user", "text", "row_no")
        same = [limited[c].eqNullSafe(numbers[c]) for c in ("window_start", "id", "hashtag", "user", "text")]
        numbered = materialize(limited.join(numbers, same, "left").select(*[limited[c] for c in limited.columns], "row_no"), "numbered")
        write_board(numbered, out)
        write_reports(numbered, out)


def last_number(spark: SparkSession, out: str, before_s: int) -> int:
    """The last row number of the latest written window that ends before ``before_s``; windows without rows have no folder."""
    earlier = [w for w in partition_values(spark, f"{out}/board", "window_end_s") if w < before_s]
    if not earlier:
        return 0
    return spark.read.parquet(f"{out}/board/window_end_s={max(earlier)}").agg(F.max("row_no").alias("n")).head()["n"] or 0


def write_board(board: DataFrame, out: str) -> None:
    """Write windows, each as a folder of its own, replacing those windows only."""
    keyed = board.withColumn("window_end_s", F.unix_seconds("window_end"))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_end_s").parquet(f"{out}/board")


def report_lines(board: DataFrame) -> DataFrame:
    """``window_end_s, value``: the report of numbered windows, sorted.  A value ends where its ruled line does.

    A window opens with its end as its time.  A status is its number, the uses of its hashtag, the hashtag, the user, the
    retweets with the status itself, and the text; dots stand for the further statuses of a hashtag.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    shown = F.concat(part("row_no"), F.lit(". "), part("hashtagcount"), F.lit(" "), part("hashtag"), F.lit(":"), part("user"), F.lit(":"),
                     part("retweets"), F.lit(" "), part("text"), F.lit(f"\n{SINGLE}"))
    rows = board.select(F.unix_seconds("window_end").alias("window_end_s"), F.lit(1).alias("_kind"), "hashtagcount", "hashtag",
                        F.coalesce("row_no", F.lit(1 << 62)).alias("_place"), F.when(F.col("overflow"), DOTS).otherwise(shown).alias("value"))
    time = F.date_format("window_end", "EEE MMM dd HH:mm:ss zzz yyyy")
    heads = board.select("window_end").distinct().select(
        F.unix_seconds("window_end").alias("window_end_s"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("hashtagcount"), F.lit("").alias("hashtag"),
        F.lit(0).cast("bigint").alias("_place"), F.concat(F.lit(f"{DOUBLE}\n Time: "), time, F.lit(f"\n{DOUBLE}")).alias("value"))
    ordered = heads.unionByName(rows).orderBy("window_end_s", "_kind", F.desc("hashtagcount"), "hashtag", "_place")
    return ordered.select("window_end_s", "value")


def write_reports(board: DataFrame, out: str) -> None:
    """Write each window's report as a text folder, replacing it; its files in name order read as one text."""
    report_lines(board).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window_end_s").text(f"{out}/report")


def report_text(spark: SparkSession, out: str) -> DataFrame:
    """``window_end_s, value``: the lines of all reports written so far, window by window."""
    lines = spark.read.text(f"{out}/report").select("window_end_s", "value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_slot"))
    return lines.orderBy("window_end_s", "_file", "_slot").select("window_end_s", "value")


def written(spark: SparkSession, out: str) -> DataFrame | None:
    """All boards written so far, or None before the first."""
    return spark.read.parquet(f"{out}/board") if exists(spark, f"{out}/board") else None
