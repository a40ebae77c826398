"""Encoding and decoding with a SentencePiece BPE model, by rounds of merges over flat arrays.

The library is asked for the pieces, their scores and kinds once; encoding and decoding are done here.  A text is cut
between two letters that stand side by side in no piece, since nothing ever merges across; that includes every place
before white space.  The letters of all new parts of a batch lie in one flat array.  In a round, every part finds its least
pair rank and merges its occurrences from the left, as many as the one-at-a-time order would merge before anything else;
the array is compacted, and parts without a pair leave it.  Parts seen before come from a bounded memory.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import pieces, small_batches

SPACE = "▁"  # stands for a space in pieces
NONE = np.int64(1) << 40  # the rank of a pair that does not merge
LONGEST = 2048  # letters of a part that is merged in rounds; a longer one by a heap, as one merge a round may be all there is
TOGETHER = 1 << 16  # letters of parts merged at a time
WHOLE = 32  # letters of a word that is not cut further
PARTS = 300_000  # parts remembered
codecs.register_error("millrace_each_byte", lambda e: ("�", e.start + 1))

_kept: dict[str, "Pieces"] = {}


def kept_pieces(path: str) -> "Pieces":
    """The model of this Python worker."""
    if path not in _kept:
        _kept[path] = Pieces(path)
    return _kept[path]


class Pieces:
    """A BPE model with byte pieces, without user-defined pieces and without a normalizer other than the white space's."""

    def __init__(self, path: str):
        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.vocab_size()
        names = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(size)]
        own = {name: i for i, name in enumerate(names) if not special[i]}
        # White space as the model's normalizer leaves it: probes, as the library does not show its settings.
        probe = sentencepiece.SentencePieceNormalizer(model_file=path)
        plain = probe.normalize("a  Åﬁ ")
        if plain != f"{SPACE}a{SPACE}{SPACE}Åﬁ{SPACE}" or any(SPACE in n.lstrip(SPACE) for n in names):
            raise ValueError(f"a model that changes texts or joins words: {plain!r}")
        self.bytes_at = next(i for i in range(size) if lib.is_byte(i))
        # Symbols are pieces, and behind them letters that are no piece but part of one.
        letters = sorted({c for name in own for c in name if c not in own})
        self.symbol = own | {c: size + k for k, c in enumerate(letters)}
        self.names = names + letters
        scores = sorted({lib.get_score(i) for i in own.values()}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        splits = [(self.symbol[n[:k]], self.symbol[n[k:]], i) for n, i in own.items() for k in range(1, len(n)) if n[:k] in self.symbol and n[k:] in self.symbol]
        left, right, merged = (np.array(x, np.int64) for x in zip(*splits, strict=True))
        self.width = len(self.names) + 1  # the last symbol is a letter in no piece
        order = np.argsort(left * self.width + right)
        self.keys = (left * self.width + right)[order]
        self.merged = merged[order]
        self.rank = np.array([rank[lib.get_score(int(i))] for i in self.merged], np.int64)
        # Filter before the search: pairs of symbols that are any key, by a hash.
        self.mask = (1 << 22) - 1
        self.some = np.zeros(self.mask + 1, bool)
        self.some[self._slot(self.keys)] = True
        # The best rank of any pair with a symbol: while it is worse than the symbol's own, all its merges go first.
        self.best = np.full(self.width, NONE)
        for side in (left, right):
            np.minimum.at(self.best, side, np.array([rank[lib.get_score(int(i))] for i in merged]))
        beside = {n[k : k + 2] for n in own for k in range(len(n) - 1)}
        self.beside = np.sort(np.array([ord(p[0]) << 21 | ord(p[1]) for p in beside], np.int64))
        self.near = np.zeros(self.mask + 1, bool)
        self.near[self._slot(self.beside)] = True
        self.letter = np.full(0x110000, -1, np.int32)
        for c, s in self.symbol.items():
            if len(c) == 1:
                self.letter[ord(c)] = s
        self.lookup = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist(), strict=True), strict=True))
        surface = [b"" if lib.is_control(i) else b" \xe2\x81\x87 " if lib.is_unknown(i) else bytes([i - self.bytes_at]) if lib.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.start = np.concatenate([[0], np.cumsum([len(b) for b in surface])])
        self.pool = np.frombuffer(b"".join(surface), np.uint8)
        self.unknown = lib.unk_id()
        self.opens = np.array([n.startswith(SPACE) and not s for n, s in zip(names, special, strict=True)])
        self.silent = np.array([lib.is_control(i) for i in range(size)])
        self.size = size
        self.memory: dict[str, bytes] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.int64(0x9E3779B97F4A7C1) >> 30) & self.mask

    def _pairs(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with the next one; the last has none."""
        keys = symbols[:-1] * self.width + symbols[1:]
        rank, merged = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        maybe = np.flatnonzero(self.some[self._slot(keys)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == keys[maybe]
            rank[maybe[hit]], merged[maybe[hit]] = self.rank[at[hit]], self.merged[at[hit]]
        return rank, merged

    def merge(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of parts (``part`` ascends) with all merges done, and their parts."""
        done_symbols, done_part = [], []
        number = 0
        while len(symbols):
            rank, merged = self._pairs(symbols)
            rank[:-1][part[1:] != part[:-1]] = NONE
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            sizes = np.diff(np.append(first, len(part)))
            least = np.minimum.reduceat(rank, first)
            spread = np.repeat(least, sizes)
            over = spread == NONE
            if over.any() and (over.sum() * 2 >= len(over) or number % 8 == 0):
                done_symbols.append(symbols[over])
                done_part.append(part[over])
                symbols, part, rank, merged, spread = (x[~over] for x in (symbols, part, rank, merged, spread))
                if not len(symbols):
                    break
            number += 1
            at = np.flatnonzero((rank == spread) & (spread < NONE))
            # Overlapping occurrences: in a chain of neighbours every other one, from the left, stays.
            chain = np.concatenate([[True], np.diff(at) != 1])
            place = np.arange(len(at)) - np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
            at = at[place % 2 == 0]
            new = merged[at]
            risky = self.best[new] <= rank[at]
            if risky.any():
                at, new = self._before_others(symbols, part, rank, at, new, risky)
            symbols = symbols.copy()
            symbols[at] = new
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, part = symbols[keep], part[keep]
        symbols, part = np.concatenate([np.zeros(0, np.int64), *done_symbols]), np.concatenate([np.zeros(0, np.int64), *done_part])
        order = np.argsort(part, kind="stable")
        return symbols[order], part[order]

    def _before_others(self, symbols, part, rank, at, new, risky) -> tuple[np.ndarray, np.ndarray]:
        """Of the merges of each part, those up to the first that makes a pair which goes before the next merge."""
        n = len(symbols)
        beside_left = np.concatenate([[False], at[1:] == at[:-1] + 2])  # the merge before made the left neighbour
        left = np.where(beside_left, np.concatenate([[0], new[:-1]]), symbols[at - 1])
        has_left = (at > 0) & (part[at] == part[at - 1])
        right_at = np.minimum(at + 2, n - 1)
        has_right = (at + 2 < n) & (part[right_at] == part[at])
        stop = np.zeros(len(at), bool)
        for there, a, b in ((has_left, left, new), (has_right, new, symbols[right_at])):
            i = np.flatnonzero(risky & there)
            keys = a[i] * self.width + b[i]
            found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            stop[i] |= (self.keys[found] == keys) & (self.rank[found] <= rank[at[i]])
        own = part[at]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        seen = np.cumsum(stop) - stop  # stops before this merge
        seen -= np.repeat(seen[first], np.diff(np.append(first, len(at))))
        return at[seen == 0], new[seen == 0]

    def merge_one(self, symbols: list[int]) -> list[int]:
        """The same for one part, one merge at a time."""
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if found := self.lookup.get(symbols[i] * self.width + symbols[j]) if j >= 0 else None:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s in symbols if s >= 0]

    def parts(self, text: str) -> list[str]:
        """A prepared text cut between letters that are side by side in no piece."""
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        keys = code[:-1] << 21 | code[1:]
        held = self.near[self._slot(keys)]
        maybe = np.flatnonzero(held)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.beside, keys[maybe]), len(self.beside) - 1)
            held[maybe] = self.beside[at] == keys[maybe]
        ends = [0, *(np.flatnonzero(~held) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def learn(self, fresh: list[str]) -> None:
        """Encode parts into the memory."""
        held, size = [], 0
        for one in [*fresh, None]:
            if held and (one is None or size + len(one) > TOGETHER):
                self._learn(held)
                held, size = [], 0
            if one is not None:
                held.append(one)
                size += len(one)

    def _learn(self, fresh: list[str]) -> None:
        code = np.frombuffer("".join(fresh).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(p) for p in fresh])
        symbols = self.letter[code].astype(np.int64)
        odd = np.flatnonzero(symbols < 0)
        symbols[odd] = self.width - 1
        part, start = np.repeat(np.arange(len(fresh)), sizes), np.cumsum(sizes) - sizes
        # Letters without an id end as bytes; until then each needs to be found again, so their places go along.
        short = np.repeat(sizes <= LONGEST, sizes)
        got, of = self.merge(symbols[short], part[short])
        for k in np.flatnonzero(sizes > LONGEST):
            one = np.array(self.merge_one(symbols[start[k] : start[k] + sizes[k]].tolist()), np.int64)
            got, of = np.concatenate([got, one]), np.concatenate([of, np.full(len(one), k)])
        order = np.argsort(of, kind="stable")
        got, of = got[order], of[order]
        ends = np.searchsorted(of, np.arange(len(fresh) + 1))
        bytewise = np.zeros(len(fresh), bool)
        bytewise[of[got >= self.size]] = True
        got32 = got.astype("<u4")
        for k, one in enumerate(fresh):
            ids = got32[ends[k] : ends[k + 1]]
            self.memory[one] = self._with_bytes(one, got[ends[k] : ends[k + 1]]) if bytewise[k] else ids.tobytes()

    def _with_bytes(self, text: str, symbols: np.ndarray) -> bytes:
        """Ids where some symbols are letters without an id, which become the ids of their bytes."""
        out, at = [], 0
        for s in symbols.tolist():
            step = len(self.names[s]) if s < self.width - 1 else 1
            out += [s] if s < self.size else [self.bytes_at + b for b in text[at : at + step].encode()]
            at += step
        return np.array(out, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; NULL and empty texts have none."""
        cut = [self._cut(text) if text else [] for text in texts]
        asked = set().union(*cut)
        fresh = asked.difference(self.memory)
        if len(self.memory) + len(fresh) > PARTS:
            self.memory = {p: self.memory[p] for p in asked.difference(fresh)}
        self.learn(list(fresh))
        get = self.memory.__getitem__
        return [np.frombuffer(b"".join(map(get, own)), "<u4") for own in cut]

    def _cut(self, text: str) -> list[str]:
        """Words with the white space before them; long ones are cut further."""
        words = WORD.findall(SPACE + text.replace(" ", SPACE))
        if len(max(words, key=len)) <= WHOLE:
            return words
        return [p for word in words for p in (self.parts(word) if len(word) > WHOLE else [word])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are no UTF-8 give U+FFFD each, control ids nothing, the first space goes."""
        ids = np.asarray(ids, np.int64)
        silent = np.flatnonzero(self.silent[ids])
        runs = [r for r in np.split(ids, silent) if len(r)] if len(silent) else [ids]  # a control id ends a run of bytes
        text = "".join([self._surface(r) for r in runs])
        spoken = np.delete(ids, silent)[:1]
        return text[1:] if len(spoken) and self.opens[spoken[0]] else text

    def _surface(self, ids: np.ndarray) -> str:
        sizes = self.start[ids + 1] - self.start[ids]
        begin = np.cumsum(sizes) - sizes
        flat = self.pool[np.repeat(self.start[ids] - begin, sizes) + np.arange(int(sizes.sum()))]
        return flat.tobytes().decode("utf-8", "millrace_each_byte")


# No piece has white space behind other letters.
WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` of each row of ``docs``: the ids of the whole text; see ``digests`` for odd rows."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_pieces(path)
        for batch in (p for b in batches for p in pieces(b, 1 << 20)):
            found = model.encode(batch.column(1).to_pylist())
            ids = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    named = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(encode, "doc_id bigint, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; NULL ids give NULL."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_pieces(path)
        for batch in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return small_batches(ids).select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: ids of the whole text, then the text of those ids.

    A row of ``docs`` gives a row, whatever its id (NULL, repeated).  NULL and empty texts have no ids and decode to nothing.
    Very long texts are encoded whole.  An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept_pieces(path)
        names = [str(i) for i in range(model.size)]
        for batch in (p for b in batches for p in pieces(b, 1 << 20)):
            rows = []
            for ids in model.encode(batch.column(1).to_pylist()):
                listed = ",".join([names[i] for i in ids.tolist()])
                rows.append((len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            types = (pa.int64(), pa.string(), pa.string())
            arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    named = small_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
