"""Token files as wavelet matrices: bit planes with rank directories, one file for each range of document ids.

A file is Parquet with a row for each block of about ``BLOCK_TOKENS`` ids: ``shard, block, doc_ids, lengths`` and
``planes``, the matrix.  A block answers access, count and occurrence lookups by itself; documents do not cross blocks.
Over files, ``token_at`` gives the ids at positions, ``count_token`` counts an id and ``occurrences`` finds it, all from the
planes that they need and without decoding a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from struct import calcsize, pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.tokens import ByteLevelEncoder, kept_encoder
from millrace.llm.words import gathered, small_batches

BLOCK_TOKENS = 1 << 17  # a plane of a block stays in a processor's cache
STEP = 512  # bits between two entries of a rank directory
HEAD = "<4sII"  # mark, bits of an id, ids
MARK = b"WVM1"
SCHEMA = "shard int, block int, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, planes binary"


class WaveletMatrix:
    """``n`` unsigned ids in ``bits`` planes.  Plane 0 holds the highest bits in text order; every plane orders the next
    one by its own bits, zeros first, so that equal ids end up side by side."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        n, bits = len(ids), max(1, int(ids.max(initial=0)).bit_length())
        now, planes, ranks = ids.astype(np.uint16 if bits <= 16 else np.uint32), [], []
        for k in range(bits - 1, -1, -1):
            ones = (now >> k & 1).astype(bool)
            packed = np.zeros(-(-n // STEP) * STEP // 8, np.uint8)
            packed[: -(-n // 8)] = np.packbits(ones, bitorder="little")
            planes.append(packed)
            ranks.append(_directory(packed))
            following, zeros = np.empty_like(now), n - int(ranks[-1][-1])
            np.compress(~ones, now, out=following[:zeros])
            np.compress(ones, now, out=following[zeros:])
            now = following
        return cls(n, planes, ranks)

    def to_bytes(self) -> bytes:
        parts = [pack(HEAD, MARK, len(self.planes), self.n)]
        for plane, rank in zip(self.planes, self.ranks, strict=True):
            parts += [rank.tobytes(), plane.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        mark, bits, n = unpack_from(HEAD, data)
        if mark != MARK:
            raise ValueError("not a wavelet matrix")
        cells, at, planes, ranks = -(-n // STEP), calcsize(HEAD), [], []
        for _ in range(bits):
            ranks.append(np.frombuffer(data, "<u4", cells + 1, at))
            at += 4 * (cells + 1)
            planes.append(np.frombuffer(data, np.uint8, cells * STEP // 8, at))
            at += cells * STEP // 8
        return cls(n, planes, ranks)

    def decode(self) -> np.ndarray:
        """All ids in text order."""
        bits = len(self.planes)
        now = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for k, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            back = np.empty_like(now)
            # Positions first: assigning through a mask takes twice the time.
            back[np.flatnonzero(~ones)], back[np.flatnonzero(ones)] = now[:zeros], now[zeros:] | now.dtype.type(1 << k)
            now = back
        return now

    def _ones(self, k: int, i: int) -> int:
        """Ones of plane ``k`` before position ``i``."""
        cell, plane = i // STEP, self.planes[k]
        begin, whole = cell * STEP // 8, i // 8
        count = int(self.ranks[k][cell]) + int(np.bitwise_count(plane[begin:whole]).sum())
        return count + (int(plane[whole]) & (1 << i % 8) - 1).bit_count() if i % 8 else count

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, zeros in enumerate(self.zeros):
            bit = self.planes[k][i // 8] >> i % 8 & 1
            ones = self._ones(k, i)
            value, i = value << 1 | int(bit), zeros + ones if bit else i - ones
        return value

    def _span(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``i`` stand below the last plane."""
        low, high = 0, i
        if value >> len(self.planes):
            return 0, 0
        for k, zeros in enumerate(self.zeros):
            a, b = self._ones(k, low), self._ones(k, high)
            low, high = (zeros + a, zeros + b) if value >> len(self.planes) - 1 - k & 1 else (low - a, high - b)
        return low, high

    def rank(self, value: int, i: int | None = None) -> int:
        """Occurrences of ``value`` before position ``i``, or in all."""
        low, high = self._span(value, self.n if i is None else i)
        return high - low

    def select(self, value: int, nth: int) -> int:
        """Position of occurrence ``nth`` (from 0) of ``value``."""
        low, high = self._span(value, self.n)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        i = low + nth
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> len(self.planes) - 1 - k & 1
            i = self._nth_bit(k, one, i - self.zeros[k] if one else i)
        return i

    def places(self, value: int) -> np.ndarray:
        """All positions of ``value``, in order: ``select`` for all its occurrences at once."""
        low, high = self._span(value, self.n)
        at = np.arange(low, high)
        for k in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bits = np.unpackbits(self.planes[k], count=self.n, bitorder="little")
            one = value >> len(self.planes) - 1 - k & 1
            at = np.flatnonzero(bits == one)[at - self.zeros[k] if one else at]
        return at

    def _nth_bit(self, k: int, one: int, nth: int) -> int:
        ranks = self.ranks[k].astype(np.int64)
        before = ranks if one else np.arange(len(ranks)) * STEP - ranks
        cell = int(np.searchsorted(before, nth, "right")) - 1
        part = np.unpackbits(self.planes[k][cell * STEP // 8 : (cell + 1) * STEP // 8], bitorder="little")
        return cell * STEP + int(np.flatnonzero(part == one)[nth - int(before[cell])])


def _directory(packed: np.ndarray) -> np.ndarray:
    ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(ones)]).astype("<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every whole text, end it with ``end_id``, and write the ids in ascending ``doc_id`` order below ``path``.

    A NULL text is an empty one; NULL ids come first; rows that repeat an id (or have none) are written one after another
    by a hash of their texts, then by the texts, and may span several files.  A block is closed by the document that fills
    it, so only one document can make it longer; a very long text makes a block of its own length.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, shard = kept_encoder(ByteLevelEncoder, tokenizer), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        ids, lengths, parts, held, block = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            matrix = WaveletMatrix.of(np.frombuffer(b"".join(parts), "<u4")).to_bytes()
            row = [[shard], [block], [held], [ids], [lengths], [matrix]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in gathered(batches):
            for doc, coded in zip(batch.column(0).to_pylist(), encoder.all_of(batch.column(1)), strict=True):
                ids.append(doc)
                lengths.append(len(coded) // 4 + 1)
                parts += [coded, end]
                held += lengths[-1]
                if held >= block_tokens:
                    yield closed()
                    ids, lengths, parts, held, block = [], [], [], 0, block + 1
        if ids:
            yield closed()

    named = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"))
    ordered = named.repartitionByRange("doc_id", "_hash").sortWithinPartitions("doc_id", "_hash", "text").select("doc_id", "text")
    ordered.mapInArrow(encode, SCHEMA).write.option("compression", "zstd").parquet(path)


def _begins(blocks: DataFrame) -> DataFrame:
    """``shard, block, _begin``: the number of ids before each block."""
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("shard", "block", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shard_start")
    )
    begins = sizes.select("shard", "block", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)).alias("_block_start"))
    return begins.join(shards, "shard").select("shard", "block", (F.col("_shard_start") + F.col("_block_start")).alias("_begin"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in files of ``write_tokens``, decoded from the planes.

    ``start`` is the number of ids of all documents before it.  The ids before a block are added up per shard and then
    over shards, of which there are as many as tasks that wrote.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    begins = _begins(blocks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                coded = memoryview(WaveletMatrix.from_bytes(row["planes"]).decode().astype("<u4")).cast("B")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                crcs = [zlib.crc32(coded[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                    ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    found = blocks.select("shard", "block", "doc_ids", "lengths", "planes").mapInArrow(
        decode, "shard int, block int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return found.join(begins, ["shard", "block"]).select(
        "doc_id", (F.col("_begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``shard, block, n``: occurrences of one id, from the rank directories alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [WaveletMatrix.from_bytes(p).rank(token) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["shard", "block", "n"])

    blocks = spark.read.schema(SCHEMA).parquet(path).select("shard", "block", "planes")
    return blocks.mapInArrow(count, "shard int, block int, n bigint")


def token_at(positions: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``position, token, doc_id`` of every distinct ``position`` (from 0 over all documents) that the files hold.

    Positions find their block through stretches of ``block_tokens`` ids, of which a block covers few, and are answered by
    the block's planes without decoding it.  NULL positions and those outside have no row.
    """
    blocks = positions.sparkSession.read.schema(SCHEMA).parquet(path)
    ends = F.col("_begin") + F.col("n_tokens")
    stretch = lambda c: F.floor(c / block_tokens)
    spans = _begins(blocks).join(blocks.select("shard", "block", "n_tokens"), ["shard", "block"]).filter("n_tokens > 0").withColumn(
        "_stretch", F.explode(F.sequence(stretch(F.col("_begin")), stretch(ends - 1))))
    asked = positions.select(F.col("position").cast("bigint").alias("position")).distinct().withColumn("_stretch", stretch(F.col("position")))
    found = asked.join(spans, "_stretch").filter((F.col("position") >= F.col("_begin")) & (F.col("position") < ends))
    # At most one entry for each id of a block.
    grouped = found.groupBy("shard", "block", "_begin").agg(F.collect_list("position").alias("positions"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                matrix, at = WaveletMatrix.from_bytes(row["planes"]), np.array(row["positions"]) - row["_begin"]
                docs = np.searchsorted(np.cumsum(row["lengths"]), at, "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["positions"], pa.int64()), pa.array([matrix.access(int(i)) for i in at], pa.int64()),
                     pa.array([row["doc_ids"][d] for d in docs], pa.int64())], ["position", "token", "doc_id"])

    return grouped.join(blocks, ["shard", "block"]).mapInArrow(answer, "position bigint, token bigint, doc_id bigint")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``nth, position, doc_id, place``: every occurrence of one id, numbered from 0, with its place in its document.

    The numbers before a block come from the rank directories, the positions from the planes upwards.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                at = WaveletMatrix.from_bytes(row["planes"]).places(token)
                ends = np.cumsum(row["lengths"])
                docs = np.searchsorted(ends, at, "right")
                starts = (ends - row["lengths"])[docs] if len(docs) else at
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(np.arange(n), pa.int64()),
                     pa.array(at, pa.int64()), pa.array([row["doc_ids"][d] for d in docs], pa.int64()), pa.array(at - starts, pa.int64())],
                    ["shard", "block", "_nth", "_at", "doc_id", "place"])

    blocks = spark.read.schema(SCHEMA).parquet(path)
    counts = count_token(spark, path, token).withColumnRenamed("n", "n_tokens")
    begins = _begins(blocks).join(_begins(counts).withColumnRenamed("_begin", "_before"), ["shard", "block"])
    found = blocks.mapInArrow(find, "shard int, block int, _nth bigint, _at bigint, doc_id bigint, place bigint")
    return found.join(begins, ["shard", "block"]).select(
        (F.col("_before") + F.col("_nth")).alias("nth"), (F.col("_begin") + F.col("_at")).alias("position"), "doc_id", "place")
