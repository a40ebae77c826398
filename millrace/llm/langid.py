"""Language of documents by Bayesian fusion of several kinds of evidence.

* The text: naive Bayes over hashed byte trigrams, its weight bounded, as neighbouring trigrams are not independent.
* A language declared in markup (``lang="xx"``) and the suffix of an address, each as a likelihood that allows for errors.
* The host: the mix of languages of its other documents, summed by grouped aggregation from text evidence alone, and
  smoothed towards the mix of its parent domain, which is smoothed towards the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import LOWER, binary, pieces, small_batches
from millrace.plans.storage import materialize

CELLS = 1 << 14
SAMPLE_ROWS = 20_000
TRIGRAM_WEIGHT = 60.0  # the evidence of a long text counts as that of so many independent trigrams
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.7
SMOOTHING = 20.0
UNSEEN = 0.1  # of a language's trigrams are the background's
ACCEPT = 0.5  # least posterior of the best language
FIT_SHARE = 0.25  # a text fits a language if it is this far from trigrams never seen towards its typical text


def trigram_cells(text: bytes | None) -> np.ndarray:
    """The cell of every byte trigram of the lower-cased text, a space on either side."""
    b = np.frombuffer(b" " + (text or b"").translate(LOWER) + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(32 - CELLS.bit_length() + 1)).astype(np.int64)


def trained(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities by cell, from about ``sample_rows`` labelled rows dealt by a hash.

    The tables have ``CELLS`` numbers for each language.
    """
    known = small_batches(docs).filter(F.col(label).isNotNull())
    share = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in (p for b in batches for p in pieces(b)):
            for lang, text in zip(batch.column(0).to_pylist(), binary(batch.column(1)), strict=True):
                cells = trigram_cells(text)
                sums.setdefault(lang, np.zeros(CELLS, np.int64))
                sums[lang] += np.bincount(cells, minlength=CELLS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "cell", "n"])

    counts = chosen.select(F.col(label).cast("string").alias("lang"), "text").mapInArrow(count, "lang string, cell bigint, n bigint")
    rows = counts.groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table: dict[str, np.ndarray] = {}
    for r in rows.collect():  # CELLS rows for each language
        table.setdefault(r.lang, np.zeros(CELLS))[r.cell] = r.n
    langs = sorted(table)
    return langs, smoothed(np.array([table[x] for x in langs]).reshape(len(langs), CELLS))


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of cells for rows of counts: a language's shares, and ``UNSEEN`` of what all languages share.

    The background weighs languages alike, and its part does not depend on how much text a language has, so that a trigram
    no language has seen speaks for none of them, however little of one was there to learn from.
    """
    if not len(counts):
        return counts
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    shared = 0.5 * shares.mean(axis=0) + 0.5 / CELLS
    return np.log((1 - UNSEEN) * shares + UNSEEN * shared)


def text_evidence(docs: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """The columns of ``docs`` but the text, ``evidence`` (log-likelihoods) and ``weight``, the trigrams that it counts as.

    ``weight`` is NULL without any text.
    """
    rest = [c for c in docs.columns if c != "text"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            evidence, weights = [], []
            for text in binary(batch.column("text")):
                cells = trigram_cells(text) if text and text.strip() else np.zeros(0, np.int64)
                mean = logs[:, cells].mean(axis=1) if 0 < len(cells) < CELLS else logs @ (np.bincount(cells, minlength=CELLS) / max(1, len(cells)))
                evidence.append((mean * min(len(cells), TRIGRAM_WEIGHT)).tolist())
                weights.append(min(len(cells), TRIGRAM_WEIGHT) if len(cells) else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(evidence, pa.list_(pa.float64())), pa.array(weights, pa.float64())], [*rest, "evidence", "weight"]
            )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest) + ", evidence array<double>, weight double"
    return docs.mapInArrow(weigh, schema)


def _softmax(x: Column) -> Column:
    shifted = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    return F.transform(shifted, lambda v: v / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def _added(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a + b)


def _mix(rows: DataFrame, keys: list[str], langs: list[str], name: str) -> DataFrame:
    """Sum of the text posteriors by ``keys``, an array in the order of ``langs``."""
    sums = [F.sum(F.get("posterior", F.lit(k))).alias(f"_{k}") for k in range(len(langs))]
    return rows.groupBy(*keys).agg(*sums).select(*keys, F.array(*(f"_{k}" for k in range(len(langs)))).alias(name))


def identify(
    docs: DataFrame, langs: list[str], logs: np.ndarray, host: Column | None = None, declared: Column | None = None,
    suffix: Column | None = None, accept: float = ACCEPT, fit_share: float = FIT_SHARE,
) -> DataFrame:
    """``doc_id, body_hash, language, posterior, fit, kept``: a row for each row of ``docs`` (``doc_id, text``).

    ``host``, ``declared`` and ``suffix`` are expressions over ``docs``; a NULL or unknown value is no evidence.  The
    parent of a host is what follows its first dot.  ``fit`` is the mean log-likelihood of a trigram in the language found,
    over that of a uniform choice.  ``kept`` is false for a text without words, for one that does not fit its language (each
    has a floor of its own, ``fit_share`` of the way from trigrams never seen to its typical text), and where no language
    reaches ``accept``; ``language`` is NULL for a text without words.  Ties go to the language first in the alphabet.
    Rows with NULL or repeated ids are judged each by itself; an empty table gives no rows.
    """
    none = F.lit(None).cast("string")
    host, declared, suffix = (none if c is None else c for c in (host, declared, suffix))
    if not langs:
        return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("body_hash"), none.alias("language"), F.lit(None).cast("double").alias("posterior"),
                           F.lit(None).cast("double").alias("fit"), F.lit(False).alias("kept"))
    never, typical = logs.min(axis=1), (np.exp(logs) * logs).sum(axis=1)
    floors = F.array(*(F.lit(float(x)) for x in never + fit_share * (typical - never) + np.log(CELLS)))
    asked = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("body_hash"), "text", host.alias("host"), F.lower(declared).alias("declared"), F.lower(suffix).alias("suffix")
    )
    seen = materialize(text_evidence(asked, langs, logs), "evidence")
    rows = seen.withColumn("posterior", _softmax(F.col("evidence"))).withColumn(
        "parent", F.nullif(F.regexp_extract("host", r"^[^.]*\.(.*)$", 1), F.lit(""))
    )
    worded = rows.filter("weight IS NOT NULL")
    flat = F.array(*(F.lit(1.0 / len(langs)) for _ in langs))
    smooth = lambda own, up: F.zip_with(
        own, up, lambda a, b: (a + SMOOTHING * b) / (F.aggregate(own, F.lit(0.0), lambda s, v: s + v) + SMOOTHING)
    )
    zeros = F.array(*(F.lit(0.0) for _ in langs))
    total = materialize(_mix(worded, [], langs, "whole"), "whole").head()["whole"]  # one number for each language
    total = [x or 0.0 for x in total] if total else [0.0] * len(langs)
    corpus = smooth(F.array(*(F.lit(float(x)) for x in total)), flat)
    hosts = materialize(_mix(worded.filter("host IS NOT NULL"), ["host", "parent"], langs, "own"), "hosts")
    sums = [F.sum(F.get("own", F.lit(k))).alias(f"_{k}") for k in range(len(langs))]
    parents = hosts.filter("parent IS NOT NULL").groupBy("parent").agg(*sums).select(
        "parent", F.array(*(f"_{k}" for k in range(len(langs)))).alias("up")
    )
    priors = materialize(
        hosts.join(materialize(parents, "parents"), "parent", "left").select("host", "own", F.coalesce("up", zeros).alias("up")), "priors"
    )
    near = lambda c, right: F.array(
        *(F.when(c.isNull() | ~c.isin(langs), 0.0).when(c == x, np.log(right)).otherwise(np.log((1 - right) / max(1, len(langs) - 1))) for x in langs)
    )
    joined = rows.select("doc_id", "body_hash", "host", "declared", "suffix", "evidence", "posterior", "weight").join(priors, "host", "left")
    # A document's own share leaves its host's mix, so that it is not its own evidence.
    others = F.zip_with(F.coalesce("own", zeros), "posterior", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    above = F.zip_with(F.coalesce("up", zeros), "posterior", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    prior = smooth(F.when(F.col("own").isNull(), zeros).otherwise(others), smooth(F.when(F.col("own").isNull(), zeros).otherwise(above), corpus))
    fused = joined.select(
        "doc_id", "body_hash", "evidence", "weight",
        _softmax(_added(_added(F.col("evidence"), F.transform(prior, lambda v: F.log(v))), _added(near(F.col("declared"), DECLARED_RIGHT), near(F.col("suffix"), SUFFIX_RIGHT)))).alias("fused"),
    )
    best = F.array_max("fused")
    place = (F.array_position(F.col("fused"), best) - 1).cast("int")
    worded = F.col("weight").isNotNull()
    judged = fused.select(
        "doc_id", "body_hash", F.when(worded, F.get(F.array(*map(F.lit, langs)), place)).alias("language"), F.when(worded, best).alias("posterior"),
        (F.get("evidence", place) / F.col("weight") + float(np.log(CELLS))).alias("fit"), F.get(floors, place).alias("_floor"),
    )
    kept = F.coalesce((F.col("fit") >= F.col("_floor")) & (F.col("posterior") >= accept), F.lit(False))
    return judged.withColumn("kept", kept).drop("_floor")


# Languages of country suffixes whose code is not the language's: fixed values.  Other suffixes are codes themselves.
SUFFIX_LANGUAGES = {
    "at": "de", "au": "en", "br": "pt", "ch": "de", "cn": "zh", "cz": "cs", "dk": "da", "ee": "et", "gr": "el", "ie": "en", "il": "he", "in": "hi", "ir": "fa",
    "jp": "ja", "kr": "ko", "mx": "es", "nz": "en", "rs": "sr", "se": "sv", "si": "sl", "tw": "zh", "ua": "uk", "uk": "en", "us": "en", "vn": "vi",
}


def address_language(addresses: Column) -> Column:
    """The language that most of the addresses' (an array) country suffixes stand for; ties go to the first in the alphabet.

    A suffix is two letters behind the last dot of a host, whatever follows the host.
    """
    hosts = F.transform(addresses, lambda a: F.lower(F.regexp_extract(a, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([A-Za-z0-9.-]+)", 1)))
    known = F.create_map(*(F.lit(x) for pair in SUFFIX_LANGUAGES.items() for x in pair))
    suffix = F.filter(F.transform(hosts, lambda h: F.regexp_extract(h, r"\.([a-z]{2})\.*$", 1)), lambda s: s != "")
    langs = F.transform(suffix, lambda s: F.coalesce(F.try_element_at(known, s), s))
    ranked = F.transform(F.array_distinct(langs), lambda x: F.struct((-F.size(F.filter(langs, lambda y: y == x))).alias("n"), x.alias("lang")))
    return F.array_min(ranked)["lang"]


def declared_language(markup: Column) -> Column:
    """The first two letters of the language that ``<html lang=...>`` declares, in lower case; NULL without one."""
    return F.nullif(F.lower(F.regexp_extract(markup, r"""(?i)<html(?=[\s])[^>]*?\slang\s*=\s*["']?([a-z]{2})(?![a-z])""", 1)), F.lit(""))


def host_of(address: Column) -> Column:
    """The host of an address, in lower case, without user and port; NULL without one."""
    return F.nullif(F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@\s]*@)?([A-Za-z0-9.-]+)", 1)), F.lit(""))


def identify_documents(docs: DataFrame) -> DataFrame:
    """``identify`` for tables ``doc_id, text, lang, source``: labels of a sample are learnt from, never used as evidence.

    The source is the host; markup and all addresses inside a text give the declared language and the suffix.
    """
    langs, logs = trained(docs)
    addresses = F.regexp_extract_all("text", F.lit(r"https?://[A-Za-z0-9.-]+"), F.lit(0))
    return identify(docs, langs, logs, F.col("source"), declared_language(F.col("text")), address_language(addresses))


def visible_text(markup: Column) -> Column:
    """Markup without comments, scripts, styles and tags."""
    bare = F.regexp_replace(markup, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``identify`` for pages ``page_id, url, html`` with languages learnt from ``docs``; ``doc_id`` is the page's id.

    All kinds of evidence take part: the visible text, the language that the markup declares, the suffix of the address,
    and the host with its parent domains.  NULL columns are no evidence; a page without visible text is not kept.
    """
    langs, logs = trained(docs)
    rows = pages.select(F.col("page_id").alias("doc_id"), visible_text(F.col("html")).alias("text"), "url", "html")
    return identify(rows, langs, logs, host_of(F.col("url")), declared_language(F.col("html")), address_language(F.array("url")))
