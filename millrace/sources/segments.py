"""Archive segments read one by one, with a status for each.

A Python data source: a partition is a segment, opened in the task that reads it.  A segment that is not there, cannot be
fetched or breaks off does not stop the others; its status row says so and how much of it was read.  Segments are unpacked
member by member as they stream in, so a task holds one chunk and one record, whatever the segment's size.
"""

from __future__ import annotations

import json
import re
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the file formats: what opens a record, what opens a gzip member.
RECORD_SEP = b"WARC/1.0\r\n"
GZIP_MAGIC = b"\x1f\x8b"

CHUNK = 1 << 20  # bytes fetched at a time
BATCH = 4 << 20  # bytes of records sent at a time
COMPLETE, BROKEN, MISSING, UNREACHABLE = "complete", "broken", "missing", "unreachable"
SCHEMA = (
    "file string, value string, status string, records bigint, bytes bigint, fetch_s double, decompress_s double, parse_s double"
)


class Broken(Exception):
    """A segment that breaks off or is no valid archive from some point on."""


@dataclass
class Segment(InputPartition):
    path: str


@dataclass
class Clock:
    """Seconds of the three steps of a segment, as the reader goes from one to the next."""

    fetch: float = 0.0
    decompress: float = 0.0
    parse: float = 0.0

    def run(self, step: str, call, *args):
        began = time.perf_counter()
        try:
            return call(*args)
        finally:
            setattr(self, step, getattr(self, step) + time.perf_counter() - began)


class SegmentSource(DataSource):
    """``paths``, a JSON list of URIs: rows with a ``value`` are raw records, rows with a ``status`` close a segment."""

    @classmethod
    def name(cls) -> str:
        return "millrace_segments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SegmentReader(json.loads(self.options["paths"]))


class SegmentReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Segment]:
        return [Segment(p) for p in self.paths]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition.path is None:  # no paths at all
            return
        clock, status, records, size = Clock(), COMPLETE, 0, 0
        held, weight = [], 0
        try:
            for record in split_records(unpacked(fetched(partition.path, clock), clock), clock):
                held.append(clock.run("parse", record.decode, "utf-8", "replace"))
                records, size, weight = records + 1, size + len(record), weight + len(record)
                if weight >= BATCH:
                    yield _rows(partition.path, held)
                    held, weight = [], 0
        except FileNotFoundError:
            status = MISSING
        except Broken:
            status = BROKEN
        except (OSError, pa.ArrowInvalid):
            status = UNREACHABLE
        if held:
            yield _rows(partition.path, held)
        closing = [partition.path, None, status, records, size, clock.fetch, clock.decompress, clock.parse]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(closing, TYPES, strict=True)], NAMES)


NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]


def _rows(path: str, values: list[str]) -> pa.RecordBatch:
    n = len(values)
    columns = [pa.array([path] * n), pa.array(values, pa.string()), *(pa.nulls(n, t) for t in TYPES[2:])]
    return pa.RecordBatch.from_arrays(columns, NAMES)


def opened(path: str):
    """An input stream of a local path or a URI of any file system that Arrow knows."""
    path = re.sub(r"^s3a:", "s3:", path)
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name, compression=None)


def fetched(path: str, clock: Clock) -> Iterator[bytes]:
    stream = clock.run("fetch", opened, path)
    with stream:
        while chunk := clock.run("fetch", stream.read, CHUNK):
            yield chunk


def unpacked(chunks: Iterator[bytes], clock: Clock) -> Iterator[bytes]:
    """The bytes of all gzip members one after another; of a file that is no gzip, the bytes as they are.

    A member that is cut off or damaged raises ``Broken`` after all bytes before the damage.
    """
    first = next(chunks, b"")
    while 0 < len(first) < 2 and (more := next(chunks, b"")):
        first += more
    if first[:2] != GZIP_MAGIC:
        if first:
            yield first
        yield from chunks
        return
    member, data = zlib.decompressobj(31), first
    while True:
        while data:
            try:
                plain = clock.run("decompress", member.decompress, data, BATCH)
            except zlib.error as e:
                raise Broken(str(e)) from e
            if plain:
                yield plain
            data = member.unconsumed_tail
            if member.eof:
                data = member.unused_data.lstrip(b"\0")  # padding between members
                member = zlib.decompressobj(31)
                if not data:
                    member = None
                    break
        data = next(chunks, b"")
        if not data:
            if member is not None:
                raise Broken("the last member is cut off")
            return
        if member is None:
            data = data.lstrip(b"\0")
            member = zlib.decompressobj(31) if data else None


def split_records(data: Iterator[bytes], clock: Clock) -> Iterator[bytes]:
    """What stands between separators; the record in which a segment breaks off is left out."""
    held = bytearray()
    searched = 0
    for chunk in data:
        held += chunk
        while (at := clock.run("parse", held.find, RECORD_SEP, searched)) >= 0:
            if at:
                yield bytes(held[:at])
            del held[: at + len(RECORD_SEP)]
            searched = 0
        searched = max(0, len(held) - len(RECORD_SEP) + 1)
    if held:
        yield bytes(held)


def scan_segments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows as ``SCHEMA``: every record of the segments, and one row with the status, counts and seconds of each segment."""
    spark.dataSource.register(SegmentSource)
    return spark.read.format(SegmentSource.name()).option("paths", json.dumps(paths or [None])).load()
