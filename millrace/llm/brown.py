"""Class-based bigram language model: exchange clustering of words, class transitions and word emissions.

A text is its lower-cased words and an end.  Units are the words that occur ``LEAST`` times or more, one by one, and the
forms (a hash of the last letters and the length) of rarer and unseen words.  The ``HEADS`` most frequent words and the
forms of all others are exchanged first, one after another, until none moves.  From these classes on all units move, half of
them at a time, each to the class that raises the likelihood of the class bigrams most, while it rises by ``GAIN`` or more.
Counts of neighbouring units lie in buckets on Spark; a unit's class, a byte, and its hash travel to the tasks.
``P(word | previous word) = P(class | previous class) * P(word | class)``, both smoothed.

Counts are complete: the most frequent words' counts travel to the tasks, those of all other words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import cut, gathered, small_batches, words_of
from millrace.plans.storage import materialize

HEADS, FORMS, CLASSES = 1024, 512, 64
UNITS = HEADS + FORMS + 1  # of the first exchange; the end of a text is the last unit
LEAST = 5  # occurrences of a word that is a unit by itself
BUCKET = 1 << 18  # tokens for a bucket of pairs
PAIRS = 1 << 18  # pairs that a task adds up at a time
TOGETHER = 256  # units whose gains are computed at a time
GAIN = 1e-4  # of the likelihood of the class bigrams, in two halves
COUNTED = 1 << 17  # words whose counts travel to the tasks
MOST = 500_000  # words that a task holds at a time
END = np.int64(-1)  # in place of a hash
ALPHA, MU, PASSES = 0.5, 2.0, 10


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7; rows without an id are learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _hash(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


@lru_cache(1 << 15)
def _form(end: bytes, length: int) -> int:
    return xxhash.xxh3_64_intdigest(end + bytes([length])) % FORMS


class Words(dict):
    """Numbers words as they come; ``hashes`` and ``forms`` are in that order."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []
        self.forms: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self.hashes.append(_hash(word))
        self.forms.append(_form(word[-3:], min(len(word), 12)))
        self[word] = number = len(self)
        return number

    def of(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def all_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of many texts one after another, and where each text ends; a distinct word is looked up once."""
        words, ends = cut(texts)
        distinct = words.dictionary
        distinct = distinct.cast(pa.large_binary() if pa.types.is_large_string(distinct.type) else pa.binary()).to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        return numbers[words.indices.to_numpy()], ends


def word_counts(texts: DataFrame) -> DataFrame:
    """``h, form, n`` of every word (by its hash) and of the end; counted in the tasks before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n, ends = Words(), np.zeros(1 << 12, np.int64), 0

        def counted() -> pa.RecordBatch:
            k = len(words)
            columns = [pa.array(words.hashes, pa.int64()), pa.array(words.forms, pa.int32()), pa.array(n[:k])]
            return pa.RecordBatch.from_arrays(columns, ["h", "form", "n"])

        for batch in gathered(batches):
            codes, _ = words.all_of(batch.column(0))
            ends += batch.num_rows
            if len(words) > len(n):
                n = np.concatenate([n, np.zeros(max(len(words), len(n)), np.int64)])
            np.add.at(n, codes, 1)
            if len(words) > MOST:
                yield counted()
                words, n = Words(), np.zeros(1 << 12, np.int64)
        yield counted()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([int(END)]), pa.array([FORMS], pa.int32()), pa.array([ends])], ["h", "form", "n"])

    parts = texts.select("text").mapInArrow(count, "h bigint, form int, n bigint")
    return parts.groupBy("h").agg(F.first("form").alias("form"), F.sum("n").alias("n"))


class Heads:
    """The units of hashes: words in order of their frequency, the forms behind the first ``HEADS`` of them, the end last."""

    def __init__(self, hashes: np.ndarray):
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.numbers = np.where(order < HEADS, order, order + FORMS).astype(np.int32)
        self.size = HEADS + FORMS + max(0, len(hashes) - HEADS) + 1

    def __len__(self) -> int:
        return len(self.hashes)

    def of(self, hashes: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return otherwise
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], otherwise)

    def get(self, h: int, otherwise: int) -> int:
        return int(self.of(np.array([h], np.int64), np.array([otherwise]))[0])


class Units(Words):
    """Words numbered, with their units.  Units and hashes are kept as arrays, so that a batch looks up its new words only."""

    def __init__(self, heads: Heads):
        super().__init__()
        self.heads = heads
        self._units, self._hashes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units(self) -> np.ndarray:
        done = len(self._units)
        if done < len(self):
            hashes, forms = np.array(self.hashes[done:], np.int64), np.array(self.forms[done:], np.int64)
            self._hashes = np.concatenate([self._hashes, hashes])
            self._units = np.concatenate([self._units, self.heads.of(hashes, HEADS + forms)])
        return self._units

    def hashed(self) -> np.ndarray:
        self.units()
        return self._hashes


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their sums."""
    keys, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


SIDES = ["keys0", "n0", "keys1", "n1"]


def unit_pairs(texts: DataFrame, heads: Heads, tokens: int) -> DataFrame:
    """``keys0, n0, keys1, n1``: counts of neighbouring units, packed; a text follows an end.

    A key is a unit times the number of units plus the unit to its right (``keys0``) or left (``keys1``).  A row is a
    bucket of units, with all pairs of each; as ends stand around the texts, each unit has both.
    """
    size, buckets = heads.size, max(8, -(-tokens // BUCKET))
    schema = "bucket int, side int, keys binary, n binary"

    def rows(found: Iterator[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "side", "keys", "n"])

    def packed(keys: list[np.ndarray], n: list[np.ndarray]) -> Iterator[tuple]:
        keys, n = _summed(keys, n)
        for side, own in ((0, keys), (1, keys % size * size + keys // size)):
            bucket = (own // size % buckets).astype(np.uint16 if buckets <= 1 << 16 else np.int64)  # 16 bits are sorted in linear time
            order = np.argsort(bucket, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
            for k in np.flatnonzero(np.diff(ends)):
                at = order[ends[k] : ends[k + 1]]
                yield int(k), side, own[at].tobytes(), n[at].astype(np.int32).tobytes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, n, held = Units(heads), [], [], 0
        for batch in gathered(batches):
            codes, ends = words.all_of(batch.column(0))
            units = np.insert(words.units()[codes].astype(np.int64), np.concatenate([[0], ends]), size - 1)
            pairs, times = np.unique(units[:-1] * size + units[1:], return_counts=True)
            keys, n, held = [*keys, pairs], [*n, times], held + len(pairs)
            if held > PAIRS:
                yield rows(packed(keys, n))
                keys, n, held = [], [], 0
            if len(words) > MOST:
                words = Units(heads)
        if held:
            yield rows(packed(keys, n))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple[int, int], tuple[list, list]] = {}
        for batch in batches:
            for bucket, side, keys, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = parts.setdefault((bucket, side), ([], []))
                part[0].append(np.frombuffer(keys, np.int64))
                part[1].append(np.frombuffer(n, np.int32).astype(np.int64))
        for bucket in sorted({b for b, _ in parts}):
            sides = [x for side in (0, 1) for x in _summed(*parts.pop((bucket, side)))]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in sides], SIDES)

    parts = texts.select("text").mapInArrow(count, schema).repartition(min(buckets, 4096), "bucket")
    return materialize(parts.mapInArrow(merge, ", ".join(f"{c} binary" for c in SIDES)), "pairs")


def table_of(pairs: DataFrame, size: int, of: np.ndarray, width: int) -> np.ndarray:
    """Counts of pairs of the groups ``of`` units, of which there are ``width``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(width * width, np.int64)
        for batch in batches:
            for keys, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(keys, np.int64)
                left = keys // size
                np.add.at(table, of[left].astype(np.int64) * width + of[keys - left * size], np.frombuffer(n, np.int64))
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells])], ["cell", "n"])

    parts = pairs.select("keys0", "n0").mapInArrow(count, "cell bigint, n bigint")
    sums = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # width squared at most
    table = np.zeros(width * width)
    table[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    return table.reshape(width, width)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchanged(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """The class of each unit.  The last unit keeps the last class for itself."""
    units, free = len(bigrams), classes - 1
    weight = bigrams.sum(1) + bigrams.sum(0)
    of = np.empty(units, np.int64)
    of[np.lexsort((np.arange(units), -weight))] = np.arange(units) % free
    of[-1] = free
    member = np.zeros((units, classes))
    member[np.arange(units), of] = 1
    right, left = bigrams @ member, bigrams.T @ member  # of a unit, by the class of its neighbour
    table = member.T @ right
    own = np.diag(bigrams)
    for _ in range(passes):
        moved = 0
        for u in range(units - 1):
            if not weight[u]:
                continue
            a = of[u]
            r, l = right[u].copy(), left[u].copy()
            r[a] -= own[u]
            l[a] -= own[u]
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= own[u]
            gains = _gains(table, r, l, own[u])[:free]
            b = int(gains.argmax())
            if gains[b] <= gains[a] + 1e-9:
                b = a
            table[b] += r
            table[:, b] += l
            table[b, b] += own[u]
            if b != a:
                moved += 1
                of[u] = b
                right[:, a] -= bigrams[:, u]
                right[:, b] += bigrams[:, u]
                left[:, a] -= bigrams[u]
                left[:, b] += bigrams[u]
        if not moved:
            break
    return of


def _gains(table: np.ndarray, r: np.ndarray, l: np.ndarray, own: float) -> np.ndarray:
    """Change of the log-likelihood when a unit with neighbours ``r``, ``l`` and ``own`` joins each class."""
    rows, columns = table.sum(1), table.sum(0)
    change = (_xlogx(table + r) - _xlogx(table)).sum(1) + (_xlogx(table + l[:, None]) - _xlogx(table)).sum(0)
    d = np.diag(table)
    change += _xlogx(d + r + l + own) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
    # Wherever the unit goes, its neighbours' rows and columns get their share; its own class gets the unit's as well.
    rows, columns = rows + l, columns + r
    more_right, more_left = r.sum() + own, l.sum() + own
    change -= _xlogx(rows + more_right) - _xlogx(rows) + _xlogx(columns + more_left) - _xlogx(columns)
    return change


def best_classes(table: np.ndarray, r: np.ndarray, l: np.ndarray, own: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The best class of each unit, now of classes ``a``; rows of ``r``, ``l`` are its neighbours by class, itself (``own``) included.

    The same choice as in ``exchanged`` for each unit alone, over the classes that it has counts in.
    """
    i, r, l, own = np.arange(len(a)), r.copy(), l.copy(), own[:, None]
    r[i, a] -= own[:, 0]
    l[i, a] -= own[:, 0]
    gains = np.zeros_like(r)
    # Neighbours of other classes than the unit's: only its own class has lost counts there.
    for x, t in ((r, table), (l, table.T)):
        k, c = np.nonzero(x)
        k, c = k[c != a[k]], c[c != a[k]]
        if len(k):
            n, e = x[k, c], np.arange(len(k))
            # Most counts are small: logarithms are taken once for a class and count.
            alike, which = np.unique(n.astype(np.int64) * len(t) + c, return_inverse=True)
            each = (_xlogx(t.T[alike % len(t)] + (alike // len(t))[:, None]) - _xlogx(t).T[alike % len(t)])[which]
            each[e, a[k]] = _xlogx(t[a[k], c]) - _xlogx(t[a[k], c] - n)
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            gains[k[first]] += np.add.reduceat(each, first, axis=0)
    for x, y, t in ((r, l, table.T[a]), (l, r, table[a])):  # neighbours of its own class
        k = np.flatnonzero(x[i, a])
        t = t[k] - y[k]
        t[np.arange(len(k)), a[k]] -= x[k, a[k]] + own[k, 0]
        gains[k] += _xlogx(t + x[k, a[k]][:, None]) - _xlogx(t)
    d, logs = np.tile(np.diag(table), (len(a), 1)), np.tile(_xlogx(np.diag(table)), (len(a), 1))
    d[i, a] -= r[i, a] + l[i, a] + own[:, 0]
    logs[i, a] = _xlogx(d[i, a])
    gains += _xlogx(d + r + l + own) - _xlogx(d + r) - _xlogx(d + l) + logs
    for x, sums in ((r, table.sum(1)), (l, table.sum(0))):
        more = x.sum(1) + own[:, 0]
        alike, which = np.unique(more, return_inverse=True)
        with_unit, without = _xlogx(sums + alike[:, None])[which], np.tile(_xlogx(sums), (len(a), 1))
        with_unit[i, a] = without[i, a]
        without[i, a] = _xlogx(sums[a] - more)
        gains -= with_unit - without
    gains = gains[:, :-1]  # the last class is the end's
    b = gains.argmax(1)
    return np.where(gains[i, b] > gains[i, a] + 1e-9, b, a)


def likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def all_exchanged(pairs: DataFrame, size: int, of: np.ndarray, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit, from the classes ``of`` on, and the counts of the class bigrams."""
    of = of.astype(np.uint8)
    table = table_of(pairs, size, of, classes)

    def neighbours(keys: np.ndarray, n: np.ndarray, of: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The units of one half in a bucket, their neighbours' counts by class, and how often they neighbour themselves."""
        units = keys // size
        first = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]])) if len(keys) else np.zeros(0, np.int64)
        units, lengths = units[first], np.diff(np.append(first, len(keys)))
        mine = (units < size - 1) & (units * 0x9E3779B1 >> 16 & 1 == half)
        picked = np.repeat(mine, lengths)
        units, lengths, n = units[mine], lengths[mine], n[picked]
        i = np.repeat(np.arange(len(units)), lengths)
        v = keys[picked] - units[i] * size
        counts = np.bincount(i * classes + of[v], n, len(units) * classes).reshape(-1, classes)
        return units, counts, np.bincount(i, n * (v == units[i]), len(units))

    def moves(of: np.ndarray, table: np.ndarray, half: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    k0, n0, k1, n1 = (np.frombuffer(batch.column(c)[row].as_py(), np.int64) for c in SIDES)
                    units, r, own = neighbours(k0, n0, of, half)
                    _, l, _ = neighbours(k1, n1, of, half)
                    parts = [slice(k, k + TOGETHER) for k in range(0, len(units), TOGETHER)]
                    best = [best_classes(table, r[p], l[p], own[p], of[units[p]].astype(np.int64)) for p in parts]
                    to = np.concatenate([np.zeros(0, np.int64), *best])
                    moved = to != of[units]
                    yield pa.RecordBatch.from_arrays([pa.array(units[moved]), pa.array(to[moved])], ["unit", "to"])

        return run

    while True:
        before, moved = likelihood(table), 0
        for half in (0, 1):
            found = pairs.mapInArrow(moves(of, table, half), "unit bigint, to bigint").toArrow()
            trial = of.copy()
            trial[found.column("unit").to_numpy()] = found.column("to").to_numpy()
            new = table_of(pairs, size, trial, classes)
            if found.num_rows and likelihood(new) > likelihood(table):
                of, table, moved = trial, new, moved + found.num_rows
        if not moved or likelihood(table) - before < GAIN * abs(before):
            return of.astype(np.int64), table


@dataclass
class Model:
    vocab: DataFrame  # h, n, class
    tokens: int
    types: int
    heads: Heads
    counts: dict[int, int]
    classes: np.ndarray
    transition: np.ndarray  # log10, class by class
    weight: np.ndarray  # log10 of what an emission of each class is divided by


def learnt(texts: DataFrame) -> Model:
    """A model of the rows of ``texts`` (column ``text``)."""
    vocab = materialize(word_counts(small_batches(texts)), "vocab")
    size = vocab.agg(F.sum("n").alias("n"), F.count("*").alias("v")).head()
    top = vocab.filter(F.col("h") != int(END)).orderBy(F.desc("n"), "h").limit(COUNTED).select("h", "n").toArrow()
    hashes, n = (top.column(c).to_numpy() for c in ("h", "n"))
    frequent = vocab.filter((F.col("h") != int(END)) & (F.col("n") >= LEAST)).orderBy(F.desc("n"), "h").select("h", "n", "form").toArrow()
    own, own_n, own_forms = (frequent.column(c).to_numpy() for c in ("h", "n", "form"))
    heads = Heads(own)
    by_form = vocab.groupBy("form").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()  # FORMS + 1 rows
    unit_n, unit_v = np.zeros(heads.size), np.zeros(heads.size)
    for r in by_form:
        unit = HEADS + r.form if r.form < FORMS else heads.size - 1
        unit_n[unit], unit_v[unit] = r.n, r.v
    np.subtract.at(unit_n, HEADS + own_forms, own_n)
    np.subtract.at(unit_v, HEADS + own_forms, 1)
    numbers = np.where(np.arange(len(own)) < HEADS, np.arange(len(own)), np.arange(len(own)) + FORMS)
    unit_n[numbers], unit_v[numbers] = own_n, 1
    coarse = np.arange(heads.size)
    coarse[numbers[HEADS:]] = HEADS + own_forms[HEADS:]
    coarse[-1] = UNITS - 1
    packed = unit_pairs(texts, heads, int(size.n or 0))
    first = exchanged(table_of(packed, heads.size, coarse, UNITS))
    classes, pairs = all_exchanged(packed, heads.size, first[coarse])
    member = np.zeros((heads.size, CLASSES))
    member[np.arange(heads.size), classes] = 1
    share = (pairs.sum(0) + 1) / (pairs.sum() + CLASSES)
    transition = np.log10((pairs + MU * share) / (pairs.sum(1, keepdims=True) + MU))
    weight = np.log10(member.T @ unit_n + ALPHA * (member.T @ unit_v + 1))
    counts = dict(zip(hashes.tolist(), n.tolist(), strict=True)) | {int(END): int(next((r.n for r in by_form if r.form == FORMS), 0))}
    return Model(vocab, int(size.n or 0), int(size.v), heads, counts, classes, transition, weight)


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    Scores are log10 probabilities of the text and its end.  A NULL or empty text is an end alone; ids may be NULL or
    repeated; an empty table gives no rows.  A word never learnt shares the place of one unseen word in its class.
    """
    heads, counts, classes, transition, weight = model.heads, model.counts, model.classes, model.transition, model.weight
    below = np.log10(model.tokens + model.types + 1)
    end_n = counts.get(int(END), 0)
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "model": pa.float64()}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n, row, last = Units(heads), np.zeros(0, np.int64), TaskContext.get().partitionId() << 33, int(classes[-1])
        for batch in gathered(batches, 8 << 20):
            codes, ends = words.all_of(batch.column(1))
            chain = np.insert(classes[words.units()][codes], np.concatenate([[0], ends]), last)
            n = np.concatenate([n, np.fromiter((counts.get(h, -1) for h in words.hashes[len(n) :]), np.int64, len(words) - len(n))])
            seen = n[codes]
            known = seen[seen >= 0]
            steps, emissions = transition[chain[:-1], chain[1:]], weight[chain[1:]]
            bases, emitted = np.log10(known + 1), np.log10(known + ALPHA)
            # Each text's words that the task knows not, a text and word once.
            rows, at = np.arange(batch.num_rows + 1), np.concatenate([[0], ends])
            texts = np.repeat(rows[:-1], np.diff(at))[seen < 0]
            keys, times = np.unique(texts * len(words) + codes[seen < 0], return_counts=True)
            tails = np.searchsorted(keys, rows * len(words)).astype(np.int32)
            befores = np.concatenate([[0], np.cumsum(seen >= 0)])[at]
            scores = []
            for k, (a, b, c, d) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), befores[:-1].tolist(), befores[1:].tolist(), strict=True)):
                moves = float(steps[a + k : b + k + 1].sum()) - float(emissions[a + k : b + k + 1].sum())
                base = float(bases[c:d].sum()) + np.log10(end_n + 1) - below * (b - a + 1)
                scores.append((base, moves + (float(emitted[c:d].sum()) + np.log10(end_n + ALPHA))))
            base, model = zip(*scores, strict=True) if scores else ([], [])
            hashes = words.hashed()[keys % max(1, len(words))]
            columns = [row + rows[:-1], batch.column(0), np.diff(at) + 1, np.diff(befores) + (end_n > 0), base, model]
            lists = [pa.ListArray.from_arrays(tails, pa.array(x, pa.int64())) for x in (hashes, times)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)), *lists], [*kinds, "tail", "times"])
            row += batch.num_rows
            if len(words) > MOST:
                words, n = Units(heads), np.zeros(0, np.int64)

    schema = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, model double, tail array<bigint>, times array<bigint>"
    named = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(named.mapInArrow(score, schema), "rows")
    # Words beyond those whose counts the tasks have: their counts are joined, a row for each text and word.
    asked = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", F.col("t.tail").alias("h"), F.col("t.times").alias("k"))
    c = F.coalesce("n", F.lit(0))
    tails = asked.join(model.vocab.select("h", "n"), "h", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10(c + 1)).alias("base_tail"),
        F.sum(F.col("k") * F.log10(c + ALPHA)).alias("model_tail"),
    )
    zero = lambda x: F.coalesce(x, F.lit(0))
    return rows.drop("tail", "times").join(tails, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("n_known") + zero("known")).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + zero("base_tail")).alias("base_score"),
        (F.col("model") + zero("model_tail")).alias("score"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """``scored`` under a model of the rows that are not held out."""
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scored(named, learnt(named.filter(~held_out()).select("text")))
