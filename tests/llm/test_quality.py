from __future__ import annotations

import random
import re
from collections import Counter

from millrace.llm import cascade
from tests.llm.rows import DOCS, documents, prose, table

WORD = re.compile("[^\x20\x09-\x0d]+")


def _brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed


def _texts():
    rng = random.Random(6)
    run = prose(rng, 12)
    return [
        run + " " + prose(rng, 30) + "\n" + run, "a b c d e f g h " * 4, "x " * 25, "\n\n a\n a\nb\nb\n \n\x0b\n", "été # $ <b>\n|%&", prose(rng, 40) + "\xa0\x1c z",
        " ".join(rng.choice("abc") for _ in range(400)), prose(rng, 50).upper(), "*** ".join(prose(rng, 40).split()), "12345 " * 40 + prose(rng, 5),
        ("one line of words\n" * 4) + prose(rng, 60), " ".join(w for x in prose(rng, 20).split() for w in [x] * 3),
    ]


def test_base_counts_are_exact(spark):
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(_texts())]
    got = cascade.quality(table(spark, rows)).collect()
    assert len(got) == len(rows)
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert have == Counter((r[0], *_brute(r[1])) for r in rows)


def test_verdict_is_that_of_all_rules_in_any_order(spark):
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(_texts())]
    got = cascade.quality(table(spark, rows)).collect()
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            hit = [name for name, rule in cascade.RULES.items() if rule(cascade.Text(texts[r.doc_id]))]
            assert r.kept == (not r.base_failed and not hit) and (r.rule is None or r.rule in hit)
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(40)) <= kept and kept.isdisjoint({1001, 1002, 1007, 1008, 1009, 1011})


def test_order_is_rejections_per_second_of_what_is_left(spark):
    def slow(t):
        sum(range(20_000))
        return True

    rules = {"never": lambda t: False, "slow": slow, "quick": lambda t: True}
    docs = spark.createDataFrame(documents(), DOCS)
    passed = sum(not cascade.base_failed(cascade.Text(r[1])) for r in documents())
    assert cascade.ordered_rules(docs, rules)[0] == "quick"
    seconds, masks = cascade.measured(docs, rules)
    assert masks == {0b110: passed} and seconds["slow"] > seconds["quick"]  # rows that fail the base take no part


def test_a_rule_that_only_repeats_another_comes_late(spark, monkeypatch):
    """The second best rule rejects what the best one has rejected; a weaker one rejects something else."""
    masks = {0b011: 90, 0b001: 10, 0b100: 20, 0: 880}
    monkeypatch.setattr(cascade, "measured", lambda *_: (dict.fromkeys("abc", 1.0), masks))
    assert cascade.ordered_rules(None, {"a": None, "b": None, "c": None}) == ["a", "c", "b"]


def test_empty_table(spark):
    assert cascade.quality(spark.createDataFrame([], DOCS)).count() == 0
