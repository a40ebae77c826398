"""Language profiles of letter trigrams, learnt from labelled documents, and detection with them.

Words are runs of letters, lower-cased and framed by ``_``; trigrams do not cross words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.status import clean_status, has_hangul, has_hiragana, language_name, language_names
from millrace.plans.numbering import numbered
from millrace.plans.storage import materialize

# Languages whose weights stand in one row, and the most such rows that are sent to all tasks.
BLOCK = 16
BROADCAST_ROWS = 100_000


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def trigrams(word: Column) -> Column:
    """All trigrams of ``_word_``; the lookahead finds overlapping ones in one pass."""
    return F.regexp_extract_all(F.concat(F.lit("_"), word, F.lit("_")), F.lit("(?=(...))"), F.lit(1))


def lang_profiles(docs: DataFrame, text: str = "text") -> DataFrame:
    """``lang, trigram, n``.  Words are counted before they are cut, so common words are cut once."""
    words = docs.select("lang", F.explode(word_array(F.col(text))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("_n"))
    return (
        words.select("lang", "_n", F.explode(trigrams(F.col("word"))).alias("trigram"))
        .groupBy("lang", "trigram")
        .agg(F.sum("_n").alias("n"))
    )


def detect_lang(docs: DataFrame, profiles: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, detected``: the language whose profile makes the text most likely (add-one smoothing).

    Languages that share no trigram with the text are not considered; a text that
    shares none with any is ``unknown``.  A text in Hiragana or Hangul is Japanese
    or Korean whatever the profiles say.  A trigram meets the weights of all languages
    in one row, or one for each ``BLOCK`` of them.  Up to ``BROADCAST_ROWS`` such rows
    go to all tasks, which add up the weights of a text as they cut it; if there are
    more, the trigrams of each text are counted first and joined by shuffle.
    """
    profiles = materialize(profiles.select("lang", "trigram", "n"), "profiles")
    cleaned = docs.select(key, clean_status(F.col(text)).alias("_text"))
    script = F.when(has_hiragana(F.col("_text")), "ja").when(has_hangul(F.col("_text")), "ko")
    # A framed word has as many trigrams as letters; positions are exploded, as substrings need no array of them.
    letters = F.length(F.regexp_replace(F.lower("_text"), r"\P{L}+", ""))
    grams = (
        cleaned.withColumn("_letters", letters)
        .select(key, "_letters", F.explode(word_array(F.col("_text"))).alias("_word"))
        .select(key, "_letters", F.concat(F.lit("_"), "_word", F.lit("_")).alias("_framed"), F.explode(F.sequence(F.lit(1), F.length("_word"))).alias("_at"))
        .select(key, "_letters", F.substr("_framed", F.col("_at"), F.lit(3)).alias("trigram"))
    )
    kinds = profiles.agg(F.count_distinct("trigram")).scalar()
    floors = profiles.groupBy("lang").agg(F.sum("n").alias("_total")).select("lang", (-F.log(F.col("_total") + kinds)).alias("_floor"))
    floors = materialize(numbered(floors.filter("lang IS NOT NULL"), [F.col("lang")], start=-1, name="_no"), "floors")
    width = max(1, min(BLOCK, floors.count()))
    block, slot = F.floor(F.col("_no") / width), F.col("_no") % width
    weights = materialize(
        profiles.join(floors, "lang")
        .groupBy("trigram", block.alias("_block"))
        .agg(*[F.sum(F.when(slot == i, F.log(F.col("n") + 1))).alias(f"_weight_{i}") for i in range(width)]),
        "weights",
    )
    if weights.count() <= BROADCAST_ROWS:
        # Look-ups by one long take a small part of the time of those by a string; a weight under the same hash counts
        # for its own trigram only.
        told = weights.withColumnRenamed("trigram", "_of").withColumn("_code", F.xxhash64("_of"))
        met = grams.withColumn("_code", F.xxhash64("trigram")).join(F.broadcast(told), "_code")
        added = [F.when(F.col("trigram") == F.col("_of"), F.col(f"_weight_{i}")) for i in range(width)]
    else:
        met = grams.groupBy(key, "_letters", "trigram").agg(F.count("*").alias("_times")).join(weights, "trigram")
        added = [F.col("_times") * F.col(f"_weight_{i}") for i in range(width)]
    # A trigram a language lacks scores the floor, which every trigram scores as well,
    # so only known trigrams are joined and the floor is added once per letter.
    known = met.groupBy(key, "_letters", "_block").agg(*[F.sum(x).alias(f"_known_{i}") for i, x in enumerate(added)])
    scored = (
        known.select(key, "_letters", F.inline(F.array(*[F.struct((F.col("_block") * width + i).alias("_no"), F.col(f"_known_{i}").alias("_known")) for i in range(width)])))
        .filter("_known IS NOT NULL")
        .join(floors, "_no")
        .withColumn("_score", F.round(F.col("_known") + F.col("_letters") * F.col("_floor"), 6))
    )
    best = scored.groupBy(key).agg(F.min_by("lang", F.struct(-F.col("_score"), F.col("lang"))).alias("_best"))
    return cleaned.select(key, script.alias("_script")).join(best, key, "left").select(
        key, F.coalesce("_script", "_best", F.lit("unknown")).alias("detected")
    )


def lang_names(docs: DataFrame) -> DataFrame:
    """Documents per language, with its English name."""
    names = language_names(docs.sparkSession)
    return docs.groupBy("lang").agg(F.count("*").alias("n")).select("lang", language_name(F.col("lang"), names).alias("lang_name"), "n")
