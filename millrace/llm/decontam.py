"""Benchmark passages in documents, up to a budget of edits, by the q-gram lemma.

A text that holds an item of ``m`` bytes with at most ``k`` edits shares at least ``m - q + 1 - k * q`` of its
q-grams, all on diagonals (place in the text less place in the item) at most ``k`` apart.  Shared q-grams are counted
in overlapping bands of diagonals, so that every run of ``k + 1`` diagonals lies inside one of them; bands that reach
the bound are verified by an alignment within the band.  Texts are compared as lower-case words with single spaces.
Items of less than ``LEAST_BYTES`` are found where their words stand in the text without any edit.  An item counts as a whole.

The items come to the tasks in blocks of bounded size, each block against all texts; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import LOWER, pieces, small_batches

Q = 8  # bytes, so that a q-gram is one 64-bit number
EDIT_SHARE = 0.1
LEAST_BYTES = 40  # of words; shorter items are looked up word by word
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 16
TABLE_BITS = 22
ODD = np.uint64(0x9E3779B97F4A7C15)
WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER)
SPAN = "item_id bigint, edits bigint, start bigint, end bigint"


def normal(text: str | None) -> bytes:
    """Lower-case words of letters and digits with one space between them, as UTF-8."""
    return b" ".join(text.lower().encode().translate(WORDS).split()) if text else b""


def _grams(data: bytes | memoryview) -> np.ndarray:
    """The q-gram at every place, as a number."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < Q:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, Q)).view(np.uint64).ravel()


def edit_budget(m: int) -> int:
    """Edits allowed in an item of ``m`` bytes; the bound on shared q-grams stays positive."""
    return max(0, min(int(EDIT_SHARE * m), (m - Q) // Q))


def aligned(item: bytes, text: bytes, low: int, high: int) -> tuple[int, int, int]:
    """Least edits of ``item`` against a part of ``text``, and where it begins and ends, on diagonals ``low .. high``."""
    width = high - low + 1
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(text, np.uint8)
    at = np.arange(width) + low  # text place on each diagonal, for item place 0
    far = len(a) + len(b) + width
    cost = np.where((at >= 0) & (at <= len(b)), 0, far)
    begin = at.copy()
    step = np.arange(width)
    skipped, skipped_begin = np.full(width, far), np.zeros(width, np.int64)
    for i in range(len(a)):
        place = at + i
        inside = (place >= 0) & (place < len(b))
        same = np.zeros(width, bool)
        same[inside] = b[place[inside]] == a[i]
        moved = np.where(inside, cost + ~same, far)  # both go on by one
        skipped[:-1], skipped_begin[:-1] = cost[1:] + 1, begin[1:]  # an item character left out: the next diagonal, as it was
        here, came = np.where(moved <= skipped, moved, skipped), np.where(moved <= skipped, begin, skipped_begin)
        here = np.where((place + 1 >= 0) & (place + 1 <= len(b)), here, far)
        # A text character left out: from the diagonal below, any number of times.
        best = np.minimum.accumulate(here - step)
        source = np.maximum.accumulate(np.where(here - step == best, step, 0))
        cost, begin = best + step, came[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), int(at[end] + len(a))


class Items:
    """A block of benchmark items with the index of their q-grams."""

    def __init__(self, known: list[tuple[int | None, bytes]]):
        rows = [x for x in known if len(x[1]) >= LEAST_BYTES]
        # Short items by their first word.
        self.short: dict[bytes, list[tuple[int | None, list[bytes]]]] = {}
        for item_id, text in known:
            if text and len(text) < LEAST_BYTES:
                self.short.setdefault(text.split()[0], []).append((item_id, text.split()))
        self.ids = [i for i, _ in rows]
        self.texts = [t for _, t in rows]
        self.lengths = np.array([len(t) for t in self.texts], np.int64)
        self.budgets = np.array([edit_budget(len(t)) for t in self.texts], np.int64)
        self.least = self.lengths - Q + 1 - self.budgets * Q
        grams = [_grams(t) for t in self.texts]
        keys = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        items = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        places = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.items, self.places = items[order], places[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._cells(self.keys)] = True

    @staticmethod
    def _cells(keys: np.ndarray) -> np.ndarray:
        return (keys * ODD >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def bands(self, text: bytes) -> Iterator[tuple[int, int]]:
        """``item, band`` pairs with enough shared q-grams."""
        # An item needs enough shared q-grams anywhere before bands are worth counting.
        totals = np.zeros(len(self.ids), np.int64)
        for _, entry in self._shared(text):
            totals += np.bincount(self.items[entry], minlength=len(totals))
        likely = totals >= self.least
        if not likely.any():
            return
        found = []
        for place, entry in self._shared(text):
            chosen = likely[self.items[entry]]
            item = self.items[entry[chosen]]
            band = (place[chosen] - self.places[entry[chosen]]) // (self.budgets[item] + 1)
            pairs = item << 40 | band + (1 << 39)
            found.append((np.concatenate([pairs, pairs - 1]), np.tile(self.places[entry[chosen]], 2)))
        pairs, where = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
        wide = int(self.lengths.max()) + 1
        places = np.unique(where * wide + np.concatenate([x for _, x in found]))  # a q-gram of the item counts once in a band
        counts = np.bincount(places // wide, minlength=len(pairs))
        items = pairs >> 40
        for pair in pairs[counts >= self.least[items]]:
            yield int(pair >> 40), int(pair & (1 << 40) - 1) - (1 << 39)

    def _shared(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in the text and entries of the index with equal q-grams, chunk by chunk."""
        for begin in range(0, max(0, len(text) - Q + 1), CHUNK):
            grams = _grams(memoryview(text)[begin : begin + CHUNK + Q - 1])
            here = np.flatnonzero(self.table[self._cells(grams)])
            at = np.searchsorted(self.keys, grams[here])
            at = np.minimum(at, len(self.keys) - 1)
            right = self.keys[at] == grams[here]
            here, at = here[right], at[right]
            n = self.count[at]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(here, n) + begin, np.repeat(self.first[at], n) + inner

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``item_id, edits, start, end`` of the best place of every item that the text holds within its budget."""
        body, best = normal(text), {}
        exact = self.exact(body)
        if not self.ids:
            return exact
        for item, band in self.bands(body):
            if item in best and not best[item][0]:
                continue
            if (at := body.find(self.texts[item])) >= 0:  # no alignment is better than an equal run
                best[item] = (0, at, at + len(self.texts[item]))
                continue
            wide = int(self.budgets[item]) + 1
            low, high = band * wide - wide, (band + 2) * wide - 1 + wide
            edits, start, end = aligned(self.texts[item], body, low, high)
            if edits <= self.budgets[item]:
                best[item] = min(best.get(item, (edits, start, end)), (edits, start, end))
        return [(self.ids[k], *best[k]) for k in sorted(best)] + exact

    def exact(self, body: bytes) -> list[tuple[int | None, int, int, int]]:
        """``matches`` of the short items: the first place where all their words stand."""
        if not self.short:
            return []
        words, at, found = body.split(), 0, {}
        for i, word in enumerate(words):
            for k, (item_id, item) in enumerate(self.short.get(word, ())):
                if (word, k) not in found and words[i : i + len(item)] == item:
                    found[word, k] = (item_id, 0, at, at + len(b" ".join(item)))
            at += len(word) + 1
        return list(found.values())


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks dealt by a hash, about ``block_bytes`` of text each, one at a time.

    Rows without a word are no items.  Rows without an id are items like all others, reported under a NULL id.
    """
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = -(-total // block_bytes) if total > block_bytes else 1
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        known = ((r.item_id, normal(r.text)) for r in part.collect())  # about block_bytes
        yield Items(sorted((x for x in known if x[1]), key=lambda x: (x[0] is not None, x[0] or 0, x[1])))


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, edits, start, end``: every item that a document holds within its edit budget, at its best place.

    Places count bytes of the normalized text.  NULL and empty texts hold nothing; rows with NULL or repeated ids are
    searched like all others; equal items under different ids are all reported; empty tables give no rows.
    """
    named = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for items in blocks(benchmark, block_bytes):
        part = named.mapInArrow(_search(items), "doc_id bigint, " + SPAN)
        found = part if found is None else found.unionAll(part)
    return found


def _search(items: Items):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            rows = [(doc, *m) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in items.matches(text)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "start", "end"])

    return search


def without_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item within its edit budget."""
    columns = small_batches(docs).columns
    body = columns.index("text")

    def keep(items: Items):
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (p for b in batches for p in pieces(b)):
                clean = [not items.matches(text) for text in batch.column(body).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return kept

    for items in blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(keep(items), docs.schema)
    return docs
