"""Token ids of whole texts with a public tokenizer file, word by word through a bounded memory.

A text is cut only where the tokenizer itself always cuts, so that the ids of the parts put together are the ids of
the whole text; parts seen before come from a dictionary.  Texts with unusual white space are encoded whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MOST_MARKS = 10_000


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level BPE files use for bytes: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()
# White space other than the space and the line feed.
OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# A space or line feed that does not stand between two other characters, or other white space.
UNUSUAL = r"\A[ \n]|[ \n]\z|[ \n][ \n]|" + OTHER_SPACE.pattern


def _letters(text: str) -> str:
    return text if text.isascii() else text.encode().decode("latin-1").translate(BYTE_LETTERS)


# What may follow a word as a part of its own: ASCII marks but the apostrophe, which begins contractions.
MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def _latin(body: str) -> bool:
    """Latin-1 letters alone; with the marks after them they are two parts to the tokenizers."""
    return body.isalpha() and (body.isascii() or max(body) <= "\u00ff")


_kept: dict[tuple[str, str], "_Encoder"] = {}


def kept_encoder(kind: type, path: str):
    """The encoder of this Python worker, so that later tasks of the worker find the words of earlier ones."""
    if (kind.__name__, path) not in _kept:
        _kept[kind.__name__, path] = kind(path)
    return _kept[kind.__name__, path]


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Encoder(dict):
    """Ids of words, kept in two generations of at most ``most`` words: what is asked again moves to the younger one."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize, self.most = self.tokenizer.model.tokenize, most
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # A text that may hold the string of a special token is the library's to cut.
        self.special = sorted({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.fresh(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def part(self, letters: str) -> bytes:
        """Ids of a part that the tokenizer does not cut, in the letters of its file."""
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def mark(self, mark: str) -> bytes:
        found = self.marks.get(mark)
        if found is None:
            if len(self.marks) >= MOST_MARKS:
                self.marks.clear()
            found = self.marks[mark] = self.part(mark)
        return found

    def whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def odd(self, text: str) -> bool:
        return any(x in text for x in self.special)


class ByteLevelEncoder(_Encoder):
    """Little-endian unsigned 32-bit ids of texts under a byte-level BPE file without a normalizer.

    Such a tokenizer cuts before every space that stands between two other characters, and around a line feed that
    does.  A key is a word without its leading space, or a line feed and a word.
    """

    def fresh(self, word: str) -> bytes:
        line = word.startswith("\n")
        body = (word[1:] if line else word).rstrip(MARKS)
        if _latin(body):
            mark = word[len(body) + line :]
            if line:
                return self.mark(BYTE_LETTERS[0x0A]) + self.part(_letters(body)) + (self.mark(mark) if mark else b"")
            return self[body] + self.mark(mark) if mark else self.part(BYTE_LETTERS[0x20] + _letters(body))
        return self.whole(word if line else " " + word)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f") if text.isascii() else OTHER_SPACE.search(text):
            return self.whole(text)
        words = text.replace("\n", " \n").split(" ")
        if "" in words or "\n" in words or self.odd(text):
            return self.whole(text)
        return self.whole(words[0]) + b"".join(map(self.__getitem__, words[1:]))

    def first(self, word: str) -> bytes:
        """Ids of the first word of a text, which has no space before it."""
        body = word.rstrip(MARKS)
        if _latin(body):
            return self.part(_letters(body)) + (self.mark(word[len(body) :]) if len(body) < len(word) else b"")
        return self.whole(word)

    def all_of(self, texts: pa.Array) -> list[bytes | memoryview]:
        """``of`` for many texts: a distinct word of them is looked up once."""
        texts = texts.fill_null("")
        unusual = pc.match_substring_regex(texts, "|".join([UNUSUAL, *map(re.escape, self.special)]))
        unusual = pc.or_(unusual, pc.equal(pc.binary_length(texts), 0))
        lists = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(unusual)), "\n", " \n"), " ")
        ends, words = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64), lists.flatten()
        starts, distinct = np.concatenate([[0], ends[:-1]])[: len(ends)], words.dictionary_encode()
        codes = distinct.indices.to_numpy().copy()
        ids = list(map(self.__getitem__, distinct.dictionary.to_pylist()))
        codes[starts] = len(ids) + np.arange(len(starts))
        ids += map(self.first, words.take(pa.array(starts)).to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))[codes]
        coded = memoryview(pa.array(ids, pa.binary()).take(pa.array(codes)).buffers()[2] or b"").cast("B")
        at = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])].tolist()
        usual = iter([coded[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
        return [self.of(t.as_py()) if odd else next(usual) for t, odd in zip(texts, unusual.to_pylist(), strict=True)]


class WordLevelEncoder(_Encoder):
    """The same for a BPE file with word ends that drops white space: every word stands alone."""

    def fresh(self, word: str) -> bytes:
        if not word:
            return b""
        body = word.rstrip(MARKS)
        if _latin(body):
            if len(body) < len(word):
                return self[body] + self.mark(word[len(body) :])
            lower = body.lower()
            return self.part(_letters(body)) if lower == body else self[lower]
        return self.whole(word)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        return self.whole(text) if self.odd(text) else b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
