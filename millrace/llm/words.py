"""Words of texts inside tasks: ASCII lower case, split at ASCII white space, hashed to 64 bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased maximal runs of bytes other than ``[\\x20\\x09-\\x0D]``; none for NULL."""
    return text.translate(LOWER).split() if text else []


def cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """``words_of`` for many texts: their words one after another, each distinct one held once, and where each text ends."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
    held = pc.greater(pc.binary_length(words), 0)  # white space at either end of a text gives an empty one
    if held.false_count:
        ends = np.concatenate([[0], np.cumsum(held.to_numpy(zero_copy_only=False))])[ends]
        words = words.filter(held)
    return words.dictionary_encode(), ends


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; a shorter text is one run, no words give none."""
    width = min(width, len(h))
    if not width:
        return h
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = mixed(out + h[k : len(h) - width + 1 + k] + np.uint64(k + 1))
    return out


def binary(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands rows to Python in batches of ``BATCH_ROWS`` and about ``BATCH_BYTES``, so that texts and
    packed rows take little memory outside the heap."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def pieces(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes, one row at least."""
    rows = max(1, min(batch.num_rows, int(batch.num_rows * most / max(1, batch.nbytes))))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def gathered(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that a word is met once in more of them."""
    held, size = [], 0
    for part in (p for b in batches for p in pieces(b)):
        if held and size + part.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(part)
        size += part.nbytes
    if held:
        yield pa.concat_batches(held)
