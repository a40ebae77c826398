"""Windowed hashtag board over a table or stream of statuses.

Input columns: ``id BIGINT, ts TIMESTAMP, user, text, lang STRING, hashtags
ARRAY<STRING>, retweet_of STRUCT<id, user, text>``.  Windows are event-time,
aligned to the epoch, ``[window_start, window_end)``; lengths are in seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.numbering import numbered
from millrace.plans.storage import materialize

WINDOW = 120
SLIDE = 10
LANGS = ("en", "no")
NO_TAG = "None"


def filter_lang(statuses: DataFrame, langs: tuple[str, ...] = LANGS) -> DataFrame:
    return statuses.filter(F.col("lang").isin(*langs))


def originals(statuses: DataFrame) -> DataFrame:
    """Statuses that are not retweets, with lower-cased hashtags."""
    return statuses.filter(F.col("retweet_of").isNull()).withColumn(
        "hashtags", F.transform("hashtags", lambda tag: F.lower(tag))
    )


def retweets(statuses: DataFrame) -> DataFrame:
    return statuses.filter(F.col("retweet_of").isNotNull())


def first_tag(statuses: DataFrame) -> DataFrame:
    """Statuses with at least one hashtag, and the first of them as ``tag``."""
    return statuses.filter(F.size("hashtags") > 0).withColumn("tag", F.get("hashtags", F.lit(0)))


def tweet_windows(statuses: DataFrame, window: int = WINDOW, slide: int = SLIDE) -> DataFrame:
    """One row per status and window it falls in, with ``window_start`` and ``window_end``."""
    return (
        statuses.withColumn("_window", F.window("ts", f"{window} seconds", f"{slide} seconds"))
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def windowed_counts(rows: DataFrame, key: Column, name: str, window: int, slide: int) -> DataFrame:
    """``window_start, window_end, <name>, n`` over sliding windows.

    Rows are counted once per slide-wide bucket; only the counted buckets are
    then added up into the windows that cover them.  Expanding each row into all
    of its windows first would multiply the rows by ``window / slide``.
    """
    keyed = rows.select("ts", key.alias(name))
    if rows.isStreaming or window % slide:
        return (
            keyed.groupBy(F.window("ts", f"{window} seconds", f"{slide} seconds").alias("_window"), name)
            .agg(F.count("*").alias("n"))
            .select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), name, "n")
        )
    step = slide * 1_000_000
    buckets = (
        keyed.withColumn("_bucket", F.floor(F.unix_micros("ts") / step)).groupBy("_bucket", name).agg(F.count("*").alias("_n"))
    )
    first = F.explode(F.sequence(F.col("_bucket") - (window // slide - 1), F.col("_bucket")))
    # Grouping by the start itself leaves the result placed as the board's joins need it.
    return (
        buckets.select(first.alias("_first"), name, "_n")
        .select(F.timestamp_micros(F.col("_first") * step).alias("window_start"), name, "_n")
        .groupBy("window_start", name)
        .agg(F.sum("_n").alias("n"))
        .select("window_start", (F.col("window_start") + F.make_dt_interval(secs=F.lit(window))).alias("window_end"), name, "n")
    )


def retweet_counts(statuses: DataFrame, window: int = WINDOW, slide: int = SLIDE) -> DataFrame:
    """``window_start, window_end, id, n``: retweets seen in the window of each original id."""
    return windowed_counts(retweets(filter_lang(statuses)), F.col("retweet_of.id"), "id", window, slide)


def hashtag_counts(
    statuses: DataFrame, window: int = WINDOW, slide: int = SLIDE, ordered: bool = False
) -> DataFrame:
    """``window_start, window_end, tag, n`` over all hashtags of the originals."""
    tags = originals(filter_lang(statuses)).select("ts", F.explode("hashtags").alias("tag"))
    counts = windowed_counts(tags, F.col("tag"), "tag", window, slide)
    return counts.orderBy("window_start", "n", "tag") if ordered else counts


def tag_popularity(windowed: DataFrame, tags: DataFrame) -> DataFrame:
    """Windowed statuses with a first ``tag``, joined with that tag's count in the window."""
    # Written first: the join then has plain shuffles on both sides, which adaptive execution splits at a hot tag.
    counts = materialize(tags.select("window_start", "tag", F.col("n").alias("hashtagcount")), "tag_counts")
    return windowed.join(counts, ["window_start", "tag"])


def tweet_board(
    statuses: DataFrame, window: int = WINDOW, slide: int = SLIDE, ordered: bool = True, details: bool = True
) -> DataFrame:
    """Each original in each of its windows, with its first tag's count and its own retweets plus one.

    Originals whose first tag is unique in the window and that were not
    retweeted are dropped; those without a tag stay, under ``None`` and count 0.
    Rows stay narrow while they are joined: user and text come last, and with
    ``details=False`` are left to ``board_details``, after a top-n for instance.
    """
    if window % slide:
        rows = _expanded_board(statuses, window, slide)
    else:
        rows = _bucketed_board(statuses, window, slide)
    board = drop_unique_unshared(
        rows.select(
            "window_start",
            "window_end",
            F.coalesce("uses", F.lit(0)).alias("hashtagcount"),
            F.coalesce("tag", F.lit(NO_TAG)).alias("hashtag"),
            "id",
            (F.coalesce("shares", F.lit(0)) + 1).alias("retweets"),
        )
    )
    board = board_details(board, statuses) if details else board
    return board.orderBy(*_board_order()) if ordered else board


# A NULL tag would send every untagged status of a window to one task; a key of its own matches no count either, and spreads.
def _own_key() -> Column:
    return F.coalesce(F.col("tag"), F.concat(F.lit("\u0000"), F.col("id").cast("string")))


def _expanded_board(statuses: DataFrame, window: int, slide: int) -> DataFrame:
    """The board's rows with ``uses`` and ``shares``, each status in each of its windows before the joins."""
    # Both are written first, see `tag_popularity`.
    shared = retweet_counts(statuses, window, slide).select("window_start", "id", F.col("n").alias("shares"))
    shared = materialize(shared, "shares")
    counts = hashtag_counts(statuses, window, slide).select("window_start", F.col("tag").alias("tag_key"), F.col("n").alias("uses"))
    counts = materialize(counts, "uses")
    return (
        originals(filter_lang(statuses))
        .select("id", "ts", F.get("hashtags", F.lit(0)).alias("tag"))
        .transform(tweet_windows, window, slide)
        .join(shared, ["window_start", "id"], "left")
        .withColumn("tag_key", _own_key())
        .join(counts, ["window_start", "tag_key"], "left")
    )


def _bucketed_board(statuses: DataFrame, window: int, slide: int) -> DataFrame:
    """The same, a status once in both joins; its windows are made inside its row at the end.

    What happens is counted by slide-wide bucket.  A status in bucket ``b`` lies in the ``window / slide`` windows that begin
    from ``b - window / slide + 1`` to ``b``, and finds the counts of all of them in one array.
    """
    step, spans = slide * 1_000_000, window // slide
    bucket = F.floor(F.unix_micros("ts") / step)
    spoken = filter_lang(statuses)
    own = originals(spoken).select("id", bucket.alias("bucket"), "hashtags")
    tags = own.select("bucket", F.explode("hashtags").alias("key"))
    shared = retweets(spoken).select(bucket.alias("bucket"), F.col("retweet_of.id").alias("key"))
    uses = _by_window(tags, tags.select("key", "bucket"), spans, "uses")
    shares = _by_window(shared, own.select(F.col("id").alias("key"), "bucket"), spans, "shares")
    statuses = own.select("id", "bucket", F.get("hashtags", F.lit(0)).alias("tag")).withColumn("tag_key", _own_key())
    joined = (
        statuses.join(shares.withColumnRenamed("key", "id"), ["id", "bucket"], "left")
        .join(uses.withColumnRenamed("key", "tag_key"), ["tag_key", "bucket"], "left")
        .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(spans - 1))))
    )
    start = F.timestamp_micros((F.col("bucket") - (spans - 1) + F.col("_k")) * step)
    return joined.select(
        "id", "tag", start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(window))).alias("window_end"),
        F.get("uses", F.col("_k")).alias("uses"), F.nullif(F.get("shares", F.col("_k")), F.lit(0)).alias("shares"),
    )


def _by_window(events: DataFrame, asked: DataFrame, spans: int, name: str) -> DataFrame:
    """``key, bucket, <name>``: for each asked key and bucket, the key's events in each of the ``spans`` windows over the bucket.

    Counted buckets send their count to the buckets whose windows they share, at most ``2 * spans - 1`` of them; an asked
    bucket adds up what reaches it, so nothing grows with a key's events or its span of time.
    """
    counted = events.groupBy("key", "bucket").agg(F.count("*").alias("n")).filter("key IS NOT NULL AND bucket IS NOT NULL")
    near = F.sequence(F.col("bucket") - (spans - 1), F.col("bucket") + (spans - 1))
    sent = counted.select("key", F.explode(near).alias("to"), "bucket", "n").select(
        "key", F.col("to").alias("bucket"), (F.col("bucket") - F.col("to")).alias("off"), "n")
    # Window k of an asked bucket covers offsets k - spans + 1 to k.
    sums = [F.coalesce(F.sum(F.when(F.col("off").between(k - spans + 1, k), F.col("n"))), F.lit(0)).alias(f"_{k}") for k in range(spans)]
    return sent.join(asked.distinct(), ["key", "bucket"], "left_semi").groupBy("key", "bucket").agg(*sums).select(
        "key", "bucket", F.array(*(f"_{k}" for k in range(spans))).alias(name))


def board_details(board: DataFrame, statuses: DataFrame) -> DataFrame:
    """Adds ``user`` and ``text`` of each row's status; rows without an id get NULLs."""
    texts = originals(statuses).groupBy("id").agg(F.min(F.struct("user", "text")).alias("_status"))
    named = board.filter("id IS NOT NULL").join(texts, "id", "left").select(
        *board.columns, F.col("_status.user").alias("user"), F.col("_status.text").alias("text")
    )
    # Rows without an id would meet in one task of the join.
    none = F.lit(None).cast("string")
    return named.unionByName(board.filter("id IS NULL").withColumns({"user": none, "text": none}))


def drop_unique_unshared(board: DataFrame) -> DataFrame:
    return board.filter((F.col("hashtagcount") != 1) | (F.col("retweets") > 1))


def board_topn(board: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` statuses of each hashtag and window, and one ``overflow`` row in place of the rest.

    ``None`` is not limited.  The rank filter is pushed below the shuffle, so each
    task sends at most ``n + 1`` rows of a hashtag however popular it is.  The two
    kinds of rows take different ways, so the (narrow) board is written out first
    instead of being computed for each.
    """
    board = materialize(board, "board")
    untagged = board.filter(F.col("hashtag") == NO_TAG).withColumn("rank", F.lit(None).cast("int"))
    by_tag = Window.partitionBy("window_start", "hashtag").orderBy("id")
    tagged = (
        board.filter(F.col("hashtag") != NO_TAG)
        .withColumn("rank", F.row_number().over(by_tag))
        .filter(F.col("rank") <= n + 1)
    )
    return _mark_overflow(tagged.unionByName(untagged), n)


def number_rows(board: DataFrame, start: int = 0) -> DataFrame:
    """Number the shown rows of a limited board on through all windows, from ``start + 1``."""
    shown = board.filter(~F.col("overflow"))
    return numbered(shown, _board_order(), start=start)


def board_preview(board: DataFrame, n: int = 10, per_tag: int = 3) -> DataFrame:
    """What a console shows of each window: its first ``n`` board rows, cut to ``per_tag`` per hashtag."""
    in_window = Window.partitionBy("window_start").orderBy(F.desc("hashtagcount"), "hashtag", "id")
    by_tag = Window.partitionBy("window_start", "hashtag").orderBy("id")
    first = board.withColumn("place", F.row_number().over(in_window)).filter(F.col("place") <= n)
    ranked = first.withColumn("rank", F.when(F.col("hashtag") != NO_TAG, F.row_number().over(by_tag)))
    return _mark_overflow(ranked.filter(F.col("rank").isNull() | (F.col("rank") <= per_tag + 1)), per_tag)


def _mark_overflow(ranked: DataFrame, n: int) -> DataFrame:
    over = F.coalesce(F.col("rank") > n, F.lit(False))
    blank = {c: F.when(~over, F.col(c)).alias(c) for c in ("id", "user", "retweets", "text") if c in ranked.columns}
    return ranked.select(*[blank.get(c, F.col(c)) for c in ranked.columns], over.alias("overflow"))


def _board_order() -> list[Column]:
    return [F.col("window_end"), F.desc("hashtagcount"), F.col("hashtag"), F.col("id")]
