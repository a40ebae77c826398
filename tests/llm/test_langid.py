from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.llm import langid
from tests.llm.rows import DOCS, documents, prose, table


def test_held_out_accuracy_and_odd_rows(spark):
    train = spark.createDataFrame(documents(1, 120), DOCS)
    langs, logs = langid.trained(train)
    assert langs == ["aa", "bb", "cc"]
    rows = documents(2)
    got = langid.identify(table(spark, rows), langs, logs, F.col("source")).collect()
    assert len(got) == len(rows)
    label = {r[0]: r[2] for r in rows[:40] if r[0] not in (5, 7)}  # those are copies of texts in another language
    assert all(r.language == label[r.doc_id] and r.kept for r in got if r.doc_id in label)
    blank = [r for r in got if r.doc_id in (40, 41, 44)]
    assert len(blank) == 3 and all(r.language is None and not r.kept for r in blank)


def test_script_never_seen_is_rejected(spark):
    langs, logs = langid.trained(spark.createDataFrame(documents(1, 120), DOCS))
    docs = spark.createDataFrame([(1, "これは日本語の文章です。" * 5, None, None, None)], DOCS)
    assert not langid.identify(docs, langs, logs).head().kept


def test_other_evidence_decides_where_the_text_does_not(spark):
    langs, logs = langid.trained(spark.createDataFrame(documents(1, 120), DOCS))
    schema = "doc_id bigint, text string, host string, declared string, suffix string"
    rng = random.Random(3)
    sure = [(100 + i, prose(rng, 40, "hklmn"), "a.site.bb", None, None) for i in range(60)]
    sure += [(200 + i, prose(rng, 40, "bcdfg"), "other.example", None, None) for i in range(60)]
    unclear = [(1, "x", None, "BB", None), (2, "x", None, "cc", "cc"), (3, "x", "a.site.bb", None, None), (4, "x", "new.site.bb", None, None),
               (5, "x", "other.example", "zz", "zz"), (6, "x", None, "aa", "aa")]
    docs = spark.createDataFrame(sure + unclear, schema)
    got = {r.doc_id: r for r in langid.identify(docs, langs, logs, F.col("host"), F.col("declared"), F.col("suffix")).collect()}
    assert [got[i].language for i in range(1, 7)] == ["bb", "cc", "bb", got[4].language, "aa", "aa"]
    assert got[3].posterior > got[4].posterior > 0.5  # a host's own texts weigh more than those of its parent


def test_priors_are_smoothed_by_parent_and_corpus(spark):
    """Brute force of the prior: a host's other texts over those of its parent over the corpus."""
    langs, logs = langid.trained(spark.createDataFrame(documents(1, 120), DOCS))
    rng = random.Random(5)
    rows = [(i, prose(rng, 30, ["bcdfg", "hklmn"][i % 3 == 0]), ["a.p", "b.p", "c.q", None][i % 4]) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, host string")
    seen = {r.doc_id: r for r in langid.text_evidence(docs.select("doc_id", "text"), langs, logs).collect()}
    import numpy as np

    soft = {d: np.exp(np.array(r.evidence) - max(r.evidence)) for d, r in seen.items()}
    soft = {d: v / v.sum() for d, v in soft.items()}
    smooth = lambda own, up: (own + langid.SMOOTHING * up) / (own.sum() + langid.SMOOTHING)
    corpus = smooth(sum(soft.values()), np.ones(len(langs)) / len(langs))
    for r in langid.identify(docs, langs, logs, F.col("host")).collect():
        host = rows[r.doc_id][2]
        mine = [soft[d] for d, _, h in rows if host and h == host and d != r.doc_id]
        near = [soft[d] for d, _, h in rows if host and h and h[2:] == host[2:] and d != r.doc_id]
        prior = smooth(sum(mine, np.zeros(len(langs))), smooth(sum(near, np.zeros(len(langs))), corpus))
        want = soft[r.doc_id] * prior
        assert abs(r.posterior - (want / want.sum()).max()) < 1e-9


def test_nothing_to_learn_and_empty_table(spark):
    langs, logs = langid.trained(spark.createDataFrame([], DOCS))
    assert langs == [] and [r.kept for r in langid.identify(spark.createDataFrame(documents()[:2], DOCS), langs, logs).collect()] == [False, False]
    langs, logs = langid.trained(spark.createDataFrame(documents(), DOCS))
    assert langid.identify(spark.createDataFrame([], DOCS), langs, logs).count() == 0


def test_a_rare_language_does_not_swallow_foreign_texts(spark):
    """Unequal training sizes: trigrams that no language has seen speak for none, and every language has its own floor."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 60, "bcdfg"), "aa", "h", 0) for i in range(400)] + [(1000 + i, prose(rng, 60, "prstv"), "cc", "h", 0) for i in range(4)]
    langs, logs = langid.trained(spark.createDataFrame(rows, DOCS))
    assert abs(logs[0].min() - logs[1].min()) < 1e-9
    foreign = [(1, "これは日本語の文章です。" * 20), (2, "Это предложение написано по-русски и довольно длинное. " * 5), (3, "ÿþ×÷ " * 40)]
    own = [(10, prose(rng, 60, "bcdfg")), (11, prose(rng, 60, "prstv"))]
    docs = spark.createDataFrame([(d, t, None, "h", 0) for d, t in foreign + own], DOCS)
    got = {r.doc_id: r for r in langid.identify(docs, langs, logs, F.col("source")).collect()}
    assert [got[i].kept for i in (1, 2, 3)] == [False] * 3
    assert [(got[i].language, got[i].kept) for i in (10, 11)] == [("aa", True), ("cc", True)]


def test_sample_of_rows_that_share_an_id(spark):
    """The sample is dealt by id and text: many rows without an id are neither all in nor all out."""
    rng = random.Random(4)
    rows = [(None, prose(rng, 20, "bcdfg"), "aa", "h", 0) for _ in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    _, logs = langid.trained(docs, sample_rows=200)
    _, whole = langid.trained(docs, sample_rows=10_000)
    assert 1e-6 < abs(logs - whole).max()  # a part
    assert logs.max() > langid.smoothed(__import__("numpy").zeros((1, langid.CELLS))).max()  # and not nothing


def test_evidence_of_addresses_and_markup(spark):
    rows = [
        ("http://www.example.de/x", '<!DOCTYPE html><html class="a" lang="DE-at">', "de", "www.example.de", "de"),
        ("https://u@news.co.uk:8080", "<html LANG=en>", "en", "news.co.uk", "en"),
        ("http://example.jp.", "<html xml:lang='fr'>", "ja", "example.jp.", None),
        ("ftp://x.example.com/a.de", "<p lang='es'>", None, "x.example.com", None),
        ("no address.de", "<htmlx lang='es'>", None, None, None), (None, None, None, None, None),
    ]
    got = spark.createDataFrame(rows, "url string, html string, suffix string, host string, declared string").select(
        "*", langid.address_language(F.array("url")).alias("s"), langid.host_of(F.col("url")).alias("h"), langid.declared_language(F.col("html")).alias("d")).collect()
    assert [(r.s, r.h, r.d) for r in got] == [r[2:] for r in rows]
    many = spark.createDataFrame([("see http://a.at/ and http://b.de: or http://c.fr, (http://d.com)",)], "text string")
    addresses = F.regexp_extract_all("text", F.lit(r"https?://[A-Za-z0-9.-]+"), F.lit(0))
    assert many.select(langid.address_language(addresses).alias("s")).head().s == "de"


def test_pages_use_all_evidence(spark):
    train = spark.createDataFrame(documents(1, 120), DOCS)
    rng = random.Random(6)
    page = lambda i, letters, lang, url: (i, url, f"<html lang='{lang}'><script>x</script><body><p>{prose(rng, 40, letters)}</p></body></html>")
    rows = [page(i, "hklmn", "bb", f"http://s.one.bb/{i}") for i in range(20)] + [page(100, "bcdfg", "aa", "http://t.two.aa/")]
    rows += [(200, "http://s.one.bb/y", "<html><body>x</body></html>"), (201, "http://q.com/", "<html lang=cc>x</html>"), (202, None, "<p></p>"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.doc_id: r for r in langid.identify_pages(pages, train).collect()}
    assert all(got[i].language == "bb" and got[i].kept for i in range(20)) and got[100].language == "aa"
    assert got[200].language == "bb" and got[201].language == "cc" and got[202].language is None and not got[202].kept and len(got) == len(rows)
