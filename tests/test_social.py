from __future__ import annotations

import math
import random
import re
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions.status import clean_status, has_hangul, has_hiragana
from millrace.operators import langs, social
from millrace.plans.storage import materialize
from millrace.streaming.board import report_text, stream_board, write_windows
from millrace.streaming.progress import Progress, drain, job_metrics
from millrace.streaming.sources import STATUS_SCHEMA, stream_markers, stream_statuses

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _status(i, second, tags=(), lang="en", of=None):
    return (i, T0 + timedelta(seconds=second), f"u{i}", f"text {i}", lang, list(tags), (of, "u", "t") if of is not None else None)


ONE_WINDOW = [
    _status(1, 1, ["X", "y"]), _status(2, 2, ["x"]), _status(4, 3, ["z"]), _status(5, 4), _status(6, 5, of=1), _status(7, 6, ["x"], lang="de"),
]


def test_board_of_one_window(spark):
    board = social.tweet_board(spark.createDataFrame(ONE_WINDOW, STATUS_SCHEMA), 60, 60)
    assert [(r.hashtagcount, r.hashtag, r.id, r.user, r.retweets, r.text) for r in board.collect()] == [
        (2, "x", 1, "u1", 2, "text 1"), (2, "x", 2, "u2", 1, "text 2"), (0, "None", 5, "u5", 1, "text 5"),
    ]


def test_top_rows_and_overflow(spark):
    rows = [_status(i, i, ["hot"]) for i in range(6)] + [_status(10 + i, i, ["warm"]) for i in range(3)] + [_status(20 + i, i) for i in range(5)]
    top = social.board_topn(social.tweet_board(spark.createDataFrame(rows, STATUS_SCHEMA), 60, 60, ordered=False))
    got = sorted((r.hashtag, -1 if r.id is None else r.id, r.overflow) for r in top.collect())
    assert got == sorted([("hot", i, False) for i in range(3)] + [("hot", -1, True)] + [("warm", 10 + i, False) for i in range(3)] + [("None", 20 + i, False) for i in range(5)])
    numbered = social.number_rows(top, start=100)
    assert [(r.row_no, r.id) for r in numbered.orderBy("row_no").collect()] == list(enumerate([0, 1, 2, 10, 11, 12, 20, 21, 22, 23, 24], 101))


def _random_statuses(n, seed=2):
    rng = random.Random(seed)
    rows, second = [], 0
    for i in range(n):
        second += rng.randrange(4)
        of = rng.randrange(max(i - 30, 0), i) if i and rng.random() < 0.3 else None
        rows.append(_status(i, second, rng.sample(["a", "b", "C", "d%d" % (i // 9)], rng.randrange(3)), rng.choice(["en", "no", "de"]), of))
    return rows


def test_bucketed_counts_equal_expanded_ones(spark):
    st = spark.createDataFrame(_random_statuses(300), STATUS_SCHEMA)
    tags = social.originals(social.filter_lang(st)).select("ts", F.explode("hashtags").alias("tag"))
    plain = tags.groupBy(F.window("ts", "60 seconds", "20 seconds").alias("w"), "tag").count().select("w.start", "w.end", "tag", "count")
    assert sorted(map(tuple, social.hashtag_counts(st, 60, 20).collect())) == sorted(map(tuple, plain.collect()))
    uneven = social.hashtag_counts(st, 50, 20)
    plain = tags.groupBy(F.window("ts", "50 seconds", "20 seconds").alias("w"), "tag").count().select("w.start", "w.end", "tag", "count")
    assert sorted(map(tuple, uneven.collect())) == sorted(map(tuple, plain.collect()))


def _write_in_steps(spark, rows, folder, steps):
    size = -(-len(rows) // steps)
    for i in range(steps):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], STATUS_SCHEMA)
        part.coalesce(1).write.mode("append").json(folder)


SHOWN = ["window_end", "row_no", "hashtagcount", "hashtag", "id", "user", "retweets", "text", "rank", "overflow"]


def _batch_board(st, window, slide, last_end):
    board = social.tweet_board(st, window, slide, ordered=False).filter(F.col("window_end") <= last_end)
    top = social.board_topn(board)
    numbers = social.number_rows(top).select("window_start", "id", "row_no")
    return sorted(map(repr, top.join(numbers, ["window_start", "id"], "left").select(*SHOWN).collect()))


def _stream(spark, tmp_path, batches, window=60, slide=20, delay=20):
    """The boards of a stream that reads one batch of rows after the other, and its progress."""
    from pathlib import Path

    for i, rows in enumerate(batches):
        part = spark.createDataFrame(rows, STATUS_SCHEMA)
        part.coalesce(1).write.json(str(tmp_path / f"part{i}"))
        file = next(Path(tmp_path / f"part{i}").glob("part-*.json"))
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i:03d}.json").write_bytes(file.read_bytes())
    progress = Progress()
    spark.streams.addListener(progress)
    st = stream_statuses(spark, str(tmp_path / "in"), files_per_batch=1)
    out = str(tmp_path / "out")
    query = stream_board(st, out, str(tmp_path / "cp"), window=window, slide=slide, delay=delay)
    query.awaitTermination()
    spark.streams.removeListener(progress)
    assert query.exception() is None
    return out, progress


def _read(spark, out):
    return sorted(map(repr, spark.read.parquet(f"{out}/board").select(*SHOWN).collect()))


def _closed(rows, delay):
    return (max(r[1] for r in rows) - timedelta(seconds=delay)).replace(tzinfo=None)


def test_stream_equals_batch(spark, tmp_path):
    rows = _random_statuses(240)
    out, progress = _stream(spark, tmp_path, [rows[i : i + 60] for i in range(0, 240, 60)])
    got = _read(spark, out)
    assert got == _batch_board(spark.createDataFrame(rows, STATUS_SCHEMA), 60, 20, _closed(rows, 20)) and len(got) > 50
    assert progress.rows >= len(rows) and progress.failed == progress.late == 0


def test_stream_equals_batch_out_of_order(spark, tmp_path):
    """Rows up to ``delay`` seconds behind the latest one lose no window, whichever batch brings them."""
    rng = random.Random(5)
    rows = _random_statuses(200, seed=6)
    mixed = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.uniform(0, 39)))
    batches = [mixed[i : i + 40] for i in range(0, 200, 40)]
    out, progress = _stream(spark, tmp_path, batches, delay=40)
    assert mixed != rows and progress.late == 0
    assert _read(spark, out) == _batch_board(spark.createDataFrame(rows, STATUS_SCHEMA), 60, 20, _closed(rows, 40))


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    batches = [[_status(1, 10), _status(2, 100)], [_status(6, 101)], [_status(3, 39), _status(4, 81), _status(5, 300)], [_status(9, 400)]]
    out, progress = _stream(spark, tmp_path, batches)
    shown = spark.read.parquet(f"{out}/board").filter("id IS NOT NULL")
    # Behind 100 seconds less the delay of 20, all three windows of second 39 have ended; those of second 81 are open.
    assert {r.id for r in shown.collect()} == {1, 2, 4, 5, 6} and progress.late > 0
    assert shown.filter("id = 4").count() == 3


def test_windows_that_are_written_again_change_nothing(spark, tmp_path):
    rows = _random_statuses(150)
    st = spark.createDataFrame(rows, STATUS_SCHEMA)
    boards = social.tweet_board(st, 60, 20, ordered=False)
    ends = sorted(r.window_end for r in boards.select("window_end").distinct().collect())
    parts = [boards.filter(F.col("window_end").isin(ends[i : i + 5])) for i in range(0, len(ends), 5)]
    out = str(tmp_path / "out")
    for part in parts:
        write_windows(part, out)
    once, text = _read(spark, out), [tuple(r) for r in report_text(spark, out).collect()]
    write_windows(parts[-1], out)
    write_windows(parts[-1].limit(0), out)
    assert _read(spark, out) == once == _batch_board(st, 60, 20, datetime(2100, 1, 1))
    assert [tuple(r) for r in report_text(spark, out).collect()] == text and len(once) > 20


def test_report_of_windows(spark, tmp_path):
    rows = [*ONE_WINDOW, *(_status(40 + i, 70 + i, ["hot"]) for i in range(5)), _status(50, 71), _status(51, 72, of=50)]
    out = str(tmp_path / "out")
    write_windows(social.tweet_board(spark.createDataFrame(rows, STATUS_SCHEMA), 60, 60, ordered=False), out)
    text = "\n".join(r.value for r in report_text(spark, out).collect())
    rule, line, dots = "=" * 50, "-" * 50, "." * 50
    assert text.split("\n") == [
        rule, " Time: Mon Jan 01 00:01:00 UTC 2024", rule,
        "1. 2 x:u1:2 text 1", line, "2. 2 x:u2:1 text 2", line, "3. 0 None:u5:1 text 5", line,
        rule, " Time: Mon Jan 01 00:02:00 UTC 2024", rule,
        "4. 5 hot:u40:1 text 40", line, "5. 5 hot:u41:1 text 41", line, "6. 5 hot:u42:1 text 42", line, dots, "7. 0 None:u50:2 text 50", line,
    ]


def test_native_windowed_counts(spark, tmp_path):
    rows = _random_statuses(200)
    _write_in_steps(spark, rows, str(tmp_path / "in"), 3)
    st = stream_statuses(spark, str(tmp_path / "in"), files_per_batch=1).withWatermark("ts", "30 seconds")
    counts = social.hashtag_counts(st, 60, 20)
    query = counts.writeStream.outputMode("complete").format("memory").queryName("tag_counts").trigger(availableNow=True).start()
    query.awaitTermination()
    want = social.hashtag_counts(spark.createDataFrame(rows, STATUS_SCHEMA), 60, 20)
    assert sorted(map(tuple, spark.table("tag_counts").collect())) == sorted(map(tuple, want.collect()))


def test_chunk_stream(spark, tmp_path):
    from millrace.operators.reads import interleave_chunks
    from millrace.sinks.files import write_chunks
    from millrace.streaming.chunks import chunk_progress, stream_chunks

    mates = spark.range(10).selectExpr("id as pair", "'n' || id as name", "'ACGT' as seq", "'IIII' as qual")
    markers = write_chunks(interleave_chunks(mates, mates, size=8), str(tmp_path / "chunks"))
    for r in markers.collect():
        (tmp_path / "marks").mkdir(exist_ok=True)
        (tmp_path / "marks" / f"files_{r.chunk}.txt").write_text(r.value + "\n")
    out = str(tmp_path / "out")
    query = stream_chunks(stream_markers(spark, str(tmp_path / "marks"), 1), str(tmp_path / "chunks"), ["wc", "-l"], out, str(tmp_path / "cp"), interval="0 seconds")
    drain(query)
    results = spark.read.parquet(out)
    assert {r.chunk: int(r.stdout) for r in results.collect()} == {0: 32, 1: 32, 2: 16}
    assert tuple(chunk_progress(markers, results).first()) == (3, 3, 3)


def test_metrics(spark):
    df, seen = job_metrics(spark.range(10), "ten", odd=F.col("id") % 2 == 1)
    assert df.filter("id > 3").count() == 6
    assert seen.get == {"rows": 10, "odd": 5}


def test_status_text(spark):
    rows = [("RT @Bob: see https://x.y/z?q RT now",), ("こんにちは",), ("안녕",), ("plain",)]
    got = spark.createDataFrame(rows, "t string").select(clean_status(F.col("t")), has_hiragana(F.col("t")), has_hangul(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(" : see RT now", False, False), ("こんにちは", True, False), ("안녕", False, True), ("plain", False, False)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_language_detection(spark, threshold):
    docs = [(1, "en", "the cat sat on the mat with the hat"), (2, "nl", "de kat zat op de mat met de hoed en het huis")]
    learnt = langs.lang_profiles(spark.createDataFrame(docs, "doc_id int, lang string, text string"))
    texts = [(1, "the hat"), (2, "het huis"), (3, "こんにちは the"), (4, "12 !"), (5, "RT the mat @hoed"), (6, "qqq")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.doc_id: r.detected for r in langs.detect_lang(spark.createDataFrame(texts, "doc_id int, text string"), learnt).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {1: "en", 2: "nl", 3: "ja", 4: "unknown", 5: "en", 6: "unknown"}


@pytest.mark.parametrize(("broadcast", "collide"), [(100_000, False), (100_000, True), (0, False)])
def test_language_detection_with_more_languages_than_a_row_holds(spark, monkeypatch, broadcast, collide):
    """Both joins give what a plain count gives, for 40 languages, rows without one, repeated ids and equal hashes."""
    monkeypatch.setattr(langs, "BROADCAST_ROWS", broadcast)
    if collide:
        monkeypatch.setattr(langs.F, "xxhash64", lambda c: F.lit(7).cast("bigint") + F.length(c))
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    docs = [(i, None if i % 41 == 40 else f"l{i % 41:02}", " ".join(word() for _ in range(12))) for i in range(120)]
    docs += [(5, "l05", docs[5][2]), (None, "l01", "aa bb"), (200, "l02", None), (201, "l02", "zzz"), (202, None, "yyy"), (203, "l03", "")]
    cut = lambda text: [f"_{w}_"[i : i + 3] for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for i in range(len(w))]
    seen = Counter((lang, g) for _, lang, text in docs for g in cut(text))
    kinds, want = len({g for _, g in seen}), {}
    for lang in sorted({x for x, _ in seen if x}):
        total = sum(n for (x, _), n in seen.items() if x == lang)
        for key, _, text in docs:
            grams = cut(text) * sum(d == (key, _, text) for d in docs)
            if key is not None and any((lang, g) in seen for g in grams):
                score = sum(math.log(seen[lang, g] + 1) for g in grams if (lang, g) in seen) - len(cut(text)) * math.log(total + kinds)
                want.setdefault(key, []).append((-round(score, 6), lang))
    rows = spark.createDataFrame(docs, "doc_id int, lang string, text string")
    found = langs.detect_lang(rows, langs.lang_profiles(rows))
    got = [tuple(r) for r in found.collect()]
    assert Counter(got) == Counter((key, min(want[key])[1] if key in want else "unknown") for key, _, _ in docs)


def test_texts_are_added_up_as_they_are_cut(spark):
    """No shuffle of a text's trigrams: they are joined by broadcast, whatever the session's threshold, before the first exchange."""
    rows = spark.createDataFrame([(1, "en", "the cat"), (2, "de", "die katze")], "doc_id int, lang string, text string")
    learnt = materialize(langs.lang_profiles(rows), "learnt")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = langs.detect_lang(rows, learnt)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    cut = plan[: plan.index("Generate explode")]
    assert cut.rindex("BroadcastHashJoin [_code") > cut.rindex("Exchange hashpartitioning")
