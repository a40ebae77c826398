"""Quality rules as a short-circuit cascade.

Each rule looks at one text and may reject it.  On a sample of the rows that pass the base, every rule is timed on texts
whose base counts are there already, as they are in the cascade, and the set of rules that reject a text is kept.  The rules
are ordered greedily: the next one rejects most per second of the texts that those before it let through.  So most bad texts
meet a cheap rule first and good texts alone pay for all.  A text is kept if no rule rejects it, whatever the order.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import pieces, small_batches

SAMPLE_ROWS = 2000
SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
WINDOW = 8


class Text:
    """What the rules ask of a text; each answer is computed once, when it is first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        """Maximal runs of characters other than ``[\\x20\\x09-\\x0D]``."""
        return self.text.encode().split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def dup_lines(self) -> int:
        """Lines equal to an earlier one."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def codes(self) -> np.ndarray:
        """Words as small numbers, equal for equal words."""
        known: dict[bytes, int] = {}
        return np.fromiter((known.setdefault(w, len(known)) for w in self.words), np.int64, len(self.words))

    @cached_property
    def repeat_words(self) -> int:
        """Words inside windows of ``WINDOW`` words that occur twice or more; equal windows are found exactly, by doubling."""
        codes, width = self.codes, 1
        while width < WINDOW:
            if len(codes) <= width:
                return 0
            pairs = codes[:-width] * (int(codes.max()) + 1) + codes[width:]
            _, codes = np.unique(pairs, return_inverse=True)
            if len(codes) == int(codes.max()) + 1:  # no two windows are equal
                return 0
            width *= 2
        twice = np.bincount(codes)[codes] > 1
        cover = np.zeros(len(codes) + WINDOW, np.int64)
        np.add.at(cover, np.flatnonzero(twice), 1)
        np.add.at(cover, np.flatnonzero(twice) + WINDOW, -1)
        return int((np.cumsum(cover) > 0).sum())

    @cached_property
    def stutters(self) -> int:
        """Words equal to the word before them."""
        return int((self.codes[1:] == self.codes[:-1]).sum())

    @cached_property
    def upper_share(self) -> float:
        letters = sum(map(str.isalpha, self.text))
        return sum(map(str.isupper, self.text)) / max(1, letters)

    @cached_property
    def digit_share(self) -> float:
        return sum(map(str.isdigit, self.text)) / max(1, self.word_chars)


RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: 10 * t.symbols > len(t.words),
    "capitals": lambda t: t.upper_share > 0.5,
    "digits": lambda t: t.digit_share > 0.5,
    "word_length": lambda t: not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words),
    "repeated_lines": lambda t: 5 * t.dup_lines > 2 * len(t.lines),
    "stutter": lambda t: 10 * t.stutters > 3 * len(t.words),
}


def base_failed(t: Text) -> bool:
    return len(t.words) < 20 or 100 * t.repeat_words > 30 * len(t.words)


def counted(t: Text) -> tuple[int, ...]:
    """The base counts of a text, in the order of the result."""
    return len(t.words), t.word_chars, t.symbols, t.dup_lines, t.repeat_words


def measured(
    docs: DataFrame, rules: dict[str, Callable[[Text], bool]] = RULES, sample_rows: int = SAMPLE_ROWS
) -> tuple[dict[str, float], dict[int, int]]:
    """Seconds of each rule, and how many texts each set of rules (a bit for each, in their order) rejects.

    Taken from those of about ``sample_rows`` rows, dealt by a hash of id and text, that pass the base.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0)).select("text")

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, masks = dict.fromkeys(rules, 0.0), Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                t = Text(body)
                counted(t)  # computed for every row, so no rule pays for it
                if base_failed(t):
                    continue
                mask = 0
                for k, (name, rule) in enumerate(rules.items()):
                    own = copy(t)  # what a rule needs beyond the base counts as its own cost
                    began = time.perf_counter()
                    mask |= bool(rule(own)) << k
                    spent[name] += time.perf_counter() - began
                masks[mask] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([*rules, *[None] * len(masks)], pa.string()), pa.array([*[None] * len(rules), *masks], pa.int64()),
             pa.array([*spent.values(), *masks.values()], pa.float64())], ["rule", "mask", "amount"])

    parts = chosen.mapInArrow(tried, "rule string, mask bigint, amount double")
    rows = parts.groupBy("rule", "mask").agg(F.sum("amount").alias("amount")).collect()  # rules, and sets of them in the sample
    return {r.rule: r.amount for r in rows if r.rule is not None}, {r.mask: int(r.amount) for r in rows if r.rule is None}


def ordered_rules(docs: DataFrame, rules: dict[str, Callable[[Text], bool]] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules: the next one rejects most per second of what is left; equal ones by name, so all of an empty sample."""
    seconds, masks = measured(docs, rules, sample_rows)
    bit, order = {name: 1 << k for k, name in enumerate(rules)}, []
    while len(order) < len(rules):
        worth = {n: (sum(c for m, c in masks.items() if m & bit[n]) + 0.01) / (seconds.get(n, 0.0) + 1e-6) for n in rules if n not in order}
        order.append(min(worth, key=lambda n: (-worth[n], n)))
        masks = {m: c for m, c in masks.items() if not m & bit[order[-1]]}
    return order


def quality(
    docs: DataFrame, rules: dict[str, Callable[[Text], bool]] = RULES, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, kept, rule`` (the first that rejected): a row for each row of ``docs``.

    A NULL text is an empty one, which has no words and fails the base; an id may be NULL or repeated; an empty table
    gives no rows.  ``kept`` is false if the base failed or any rule rejects; ``rule`` depends on the order found.
    """
    named = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    order = ordered_rules(named, rules, sample_rows)
    cascade = [(name, rules[name]) for name in order]
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t = Text(body)
                base, failed = counted(t), base_failed(t)
                hit = None if failed else next((name for name, rule in cascade if rule(t)), None)
                rows.append((doc, *base, failed, not failed and hit is None, hit))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*counts, "base_failed", "kept", "rule"]
            )

    schema = ", ".join(f"{c} bigint" for c in counts) + ", base_failed boolean, kept boolean, rule string"
    return named.mapInArrow(judge, schema)
