from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from millrace.operators import words
from millrace.sinks.files import write_freq

LINE = "Don't stop, don't! _a_ b*c"


def _lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "line string")


def test_segments(spark):
    got = [r.words for r in words.segments(_lines(spark, LINE, "", " _ '")).collect()]
    assert got == [["don't", "stop"], ["don't"], ["a", "b", "c"]]
    assert [r.words for r in words.multiword(words.segments(_lines(spark, LINE))).collect()] == [["don't", "stop"], ["a", "b", "c"]]


def test_bigrams(spark):
    got = {(r.word, r.pred) for r in words.bigram_counts(_lines(spark, LINE)).collect()}
    assert got == {("stop", "don't"), ("b", "a"), ("c", "b")}


# The patterns of segments, words and trimming are the definition itself.
def _by_hand(line):
    for segment in re.split(r"[^\w' *]+", line.lower(), flags=re.A):
        parts = (re.sub(r"^[^a-z0-9]*([\w']*?)[^a-z0-9]*$", r"\1", w, flags=re.A) for w in re.split(r"[^\w']+", segment, flags=re.A))
        yield [w for w in parts if w]


TEXTS = ["the cat and the dog", "the end", "été là-bas __x_y__ 'n' o'clock*five", "a.b.a b", "one", "A_b' 'c_ d''e"]


def test_against_the_definition(spark):
    segs = [s for x in TEXTS for s in _by_hand(x)]
    counts = Counter(w for s in segs for w in s)
    pairs = Counter((b, a) for s in segs for a, b in zip(s, s[1:], strict=False))
    rows = words.word_freq(_lines(spark, *TEXTS)).collect()
    assert {r.word: r.n for r in rows} == counts
    assert {(r.word, r.pred): r.pred_n for r in rows if r.pred is not None} == pairs
    assert [(r.n, r.word) for r in rows] == sorted([(r.n, r.word) for r in rows], key=lambda x: (-x[0], x[1]))
    assert {r.word: r.n for r in words.word_counts(_lines(spark, *TEXTS)).collect()} == counts


def test_predecessor_lists_stay_whole(spark):
    texts = [f"w{i} hub" for i in range(30)] + ["w1 hub", "lonely"]
    rows = words.predecessor_lists(_lines(spark, *texts)).collect()
    assert {r.pred: r.n for r in rows if r.word == "hub"} == {f"w{i}": 1 + (i == 1) for i in range(30)}
    assert [(r.pred, r.n) for r in rows if r.word == "lonely"] == [(None, None)] and len(rows) == 61


def test_freq_text(spark, tmp_path):
    write_freq(words.word_freq(_lines(spark, "b a", "b a", "c a")), str(tmp_path / "freq"))
    text = "".join(p.read_text() for p in sorted(Path(tmp_path / "freq").glob("part-*")))
    assert text == "a:3\n\tb:2\n\tc:1\nb:2\nc:1\n"
