from __future__ import annotations

import gzip

from millrace.operators import phones
from millrace.sinks.files import write_phone_index
from millrace.sources import segments
from millrace.sources.archive import entry_statuses, listed_segments, manifest_entries, scan_manifest, scan_wet, split_manifest


def _record(url, body):
    target = f"WARC-Target-URI: {url}\r\n" if url else ""
    return f"WARC/1.0\r\nWARC-Type: conversion\r\n{target}Content-Length: {len(body)}\r\n\r\n{body}\r\n\r\n".encode()


BODIES = [("http://a.nl/", "call +31 20 1234567.\r\n\r\nmore"), (None, "tel 0031201234567."), ("http://b.nl/" + "x" * 3000, "a +31 800 1234")]


def _archive(path):
    path.write_bytes(b"".join(gzip.compress(_record(u, b)) for u, b in BODIES))
    return str(path)


def test_wet_scan(spark, tmp_path):
    rows = {r.url: r.content for r in scan_wet(spark, _archive(tmp_path / "x.warc.wet.gz")).collect()}
    assert rows == {"http://a.nl/": BODIES[0][1] + "\r\n\r\n", BODIES[2][0]: BODIES[2][1] + "\r\n\r\n"}


def test_manifest(spark, tmp_path):
    good = "file:" + _archive(tmp_path / "y.warc.wet.gz")
    (tmp_path / "m.txt").write_text(f"{good}\nftp://x\ns3:/broken\n\n")
    records, rejects = scan_manifest(spark, str(tmp_path / "m.txt"))
    hits = phones.phone_hits(records)
    assert sorted(r.num for r in hits.collect()) == ["0201234567", "08001234"]
    assert sorted((r.uri, r.status) for r in rejects.collect()) == [("ftp://x", "unknown"), ("s3:/broken", "invalid")]
    entries = split_manifest(spark.createDataFrame([(good,), ("ftp://x",), ("s3://b/k",), ("s3:/broken",)], "value string"))
    assert phones.phone_stats(hits, entries).first().asDict() == {
        "unique_numbers": 2, "hits": 2, "segments": 4, "processed_segments": 2, "failed_segments": 2,
    }
    assert {r.path for r in entries.collect()} == {good, None, "s3a://b/k"}
    write_phone_index(phones.phone_index(hits), str(tmp_path / "index"))
    assert [r.url for r in spark.read.parquet(str(tmp_path / "index")).filter("num = '0201234567'").collect()] == ["http://a.nl/"]


def test_segments_that_are_missing_or_broken(spark, tmp_path):
    good = _archive(tmp_path / "good.warc.wet.gz")
    whole = (tmp_path / "good.warc.wet.gz").read_bytes()
    first = len(gzip.compress(_record(*BODIES[0])))
    cuts = {"start": whole[:40], "half": whole[: first + 30], "damaged": whole[:first] + b"\x1f\x8b\x08garbage", "empty": b"", "padded": whole + bytes(512)}
    for name, data in cuts.items():
        (tmp_path / f"{name}.gz").write_bytes(data)
    (tmp_path / "plain.wet").write_bytes(b"".join(_record(u, b) for u, b in BODIES))
    names = [good, *(f"{tmp_path}/{n}.gz" for n in [*cuts, "none"]), f"{tmp_path}/plain.wet"]
    (tmp_path / "m.txt").write_text("".join(f"file:{n}\n" for n in names) + "ftp://x\n")
    entries = manifest_entries(spark, str(tmp_path / "m.txt"))
    scan = listed_segments(entries)
    assert scan.rdd.getNumPartitions() == len(names)
    hits, closed = phones.crawl(scan)
    got = {r.file.rsplit("/", 1)[1]: (r.status, r.records) for r in closed.collect()}
    assert got == {"good.warc.wet.gz": ("complete", 3), "start.gz": ("broken", 0), "half.gz": ("broken", 1), "damaged.gz": ("broken", 0),
                   "empty.gz": ("complete", 0), "padded.gz": ("complete", 3), "none.gz": ("missing", 0), "plain.wet": ("complete", 3)}
    assert sorted(r.num for r in hits.collect()) == ["0201234567"] * 4 + ["08001234"] * 3
    statuses = entry_statuses(entries, closed)
    stats = phones.phone_stats(hits, statuses).first()
    assert (stats.unique_numbers, stats.hits, stats.segments, stats.processed_segments, stats.failed_segments) == (2, 7, 9, 4, 5)
    totals = phones.segment_totals(closed).first()
    assert (totals.segments, totals.complete_segments, totals.broken_segments, totals.missing_segments, totals.unreachable_segments, totals.records) == (8, 4, 3, 1, 0, 10)
    assert totals.bytes > 3000 and min(totals.fetch_s, totals.decompress_s, totals.parse_s) > 0
    records, rejects = scan_manifest(spark, str(tmp_path / "m.txt"))
    assert records.count() == 3 * 2 + 1 and rejects.count() == 5
    assert {r.status for r in rejects.collect()} == {"broken", "missing", "unknown"}


def test_half_a_segment_of_many_records(spark, tmp_path):
    """What stands before the break is kept, counted, and the rest is not lost in silence."""
    data = b"".join(gzip.compress(_record(f"http://x/{i}", f"tel +31 20 {i:07d}.")) for i in range(4000))
    (tmp_path / "a.gz").write_bytes(data)
    (tmp_path / "b.gz").write_bytes(data[: len(data) // 2])
    hits, closed = phones.crawl(segments.scan_segments(spark, [f"{tmp_path}/a.gz", f"file:{tmp_path}/b.gz"]))
    rows = {r.file.rsplit("/", 1)[1]: r for r in closed.collect()}
    assert rows["a.gz"].records == 4000 and rows["a.gz"].status == "complete" and rows["b.gz"].status == "broken"
    assert hits.count() == 4000 + rows["b.gz"].records and 1900 < rows["b.gz"].records < 2100


def test_records_and_members_at_any_chunk_border(monkeypatch, tmp_path):
    data = b"".join(gzip.compress(_record(u, b)) for u, b in BODIES)
    (tmp_path / "x.gz").write_bytes(data)
    want = [_record(u, b)[len(segments.RECORD_SEP):] for u, b in BODIES]
    for size in (1, 2, 3, 7, 64, 1 << 20):
        monkeypatch.setattr(segments, "CHUNK", size)
        monkeypatch.setattr(segments, "BATCH", max(1, size // 2))
        clock = segments.Clock()
        assert list(segments.split_records(segments.unpacked(segments.fetched(f"{tmp_path}/x.gz", clock), clock), clock)) == want


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "m.txt").write_text("ftp://x\n")
    records, rejects = scan_manifest(spark, str(tmp_path / "m.txt"))
    assert records.count() == 0 and rejects.count() == 1
