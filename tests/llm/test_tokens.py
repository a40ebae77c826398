from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing, tokens, wavelet
from millrace.llm.tokens import ByteLevelEncoder, WordLevelEncoder
from tests.llm.rows import DOCS, documents, table

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", "a", "  a  b\n\n c", "a\tb \n d e", "It's don't  we'll.\n\nX", "<|endoftext|> a <|endoftext|>b", "\n", "a \n b", "a\n", "é́ é ́x y",
    "ÀÉ ÇA Straße İstanbul ǅ", "12345 6a7b", "a\x1cb \x85c", "日本語 テスト\nabc", "x\n\ty", "　a b", "a\r\nb c", "ÿ Ÿ µ ª ß é. ê, .x ,y x.. a., ",
]


def _hash(text):
    """Spark's xxhash64 of a text; a NULL leaves the seed."""
    return 42 if text is None else xxhash.xxh64(text.encode(), seed=42).intdigest() - (1 << 64 if xxhash.xxh64(text.encode(), seed=42).intdigest() >> 63 else 0)


def _whole(path):
    t = Tokenizer.from_file(path)
    return lambda x: np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize(("kind", "path"), [(ByteLevelEncoder, BYTES), (WordLevelEncoder, WORDS)])
def test_word_by_word_equals_whole_text(kind, path):
    rng, whole, encoder = random.Random(2), _whole(path), kind(path, most=50)
    bits = [" ", "  ", "\n", "\t", "ab", "Éa", ".", ",", "'s", "12", "é", "語", " ", "x-y"]
    texts = ODD + [r[1] for r in documents()] + ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(3000)]
    assert [x for x in texts if encoder.of(x) != whole(x)] == []


@pytest.mark.parametrize(("kind", "path"), [(ByteLevelEncoder, BYTES), (WordLevelEncoder, WORDS)])
def test_marked_words_are_put_together(kind, path, monkeypatch):
    """Words with marks behind them, words of other cases and first words of lines have their ids without the library's cuts."""
    rng, whole, encoder = random.Random(4), _whole(path), kind(path, most=40)
    monkeypatch.setattr(tokens, "MOST_MARKS", 5)
    asked, cut = [], encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda text: asked.append(text) or cut(text))
    word = lambda: rng.choice(["ab", "Ab", "É", "straße", "THE"]) + "".join(rng.choices(tokens.MARKS.replace("|", ""), k=rng.randint(0, 5)))
    texts = ["".join(word() + rng.choice(" \n") for _ in range(9)) + "x" for _ in range(500)]
    assert [x for x in texts if encoder.of(x) != whole(x)] == []
    assert all(x == re.split("[ \n]", y)[0] for x, y in zip(asked, texts, strict=True)) if kind is ByteLevelEncoder else not asked


def test_many_texts_equal_whole_texts(monkeypatch):
    """A distinct word is looked up once for all texts; only unusual ones are the library's to cut."""
    rng, whole, encoder = random.Random(3), _whole(BYTES), ByteLevelEncoder(BYTES, most=50)
    bits = [" ", " ", "\n", "\t", "ab", "Éa", ".", "'s", "12", "é", "語", "x-y", "<|"]
    texts = [None, *ODD, *(r[1] for r in documents()), *("".join(rng.choices(bits, k=rng.randint(1, 8))) for _ in range(3000))]
    for column in (pa.array(texts, pa.string()), pa.array(texts, pa.large_string()), pa.array(["x y", *texts])[1:], pa.array([], pa.string()), pa.array([""])):
        assert [bytes(x) for x in encoder.all_of(column)] == [whole(x) for x in column.to_pylist()]
    assert encoder.all_of(pa.array(["ab. cd\nef"] * 3)) == [whole("ab. cd\nef")] * 3
    asked, plain = [], ByteLevelEncoder(BYTES)
    monkeypatch.setattr(plain, "of", asked.append)
    monkeypatch.setattr(plain, "fresh", lambda word: asked.append(word) or b"")
    plain.all_of(pa.array(["The ab cd\nab, ab"] * 100))
    assert sorted(asked) == sorted(["The", "ab", "cd", "\nab,"])


def test_matrix_answers_like_a_list():
    rng = np.random.default_rng(5)
    for n, top in ((0, 1), (1, 1), (700, 3), (1500, 50_000), (513, 2**20)):
        ids = rng.integers(0, top, n)
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
        assert m.decode().tolist() == ids.tolist()
        for i in rng.integers(0, n, 20).tolist() if n else []:
            assert m.access(i) == ids[i] and m.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
        for v in {*ids[:10].tolist(), top + 1}:
            places = np.flatnonzero(ids == v)
            assert m.places(v).tolist() == places.tolist()
            assert m.rank(v) == len(places) and [m.select(v, k) for k in range(len(places))] == places.tolist()
            with pytest.raises(IndexError):
                m.select(v, len(places))


def test_token_files_round_trip(spark, tmp_path):
    rows = documents()
    path = str(tmp_path / "tokens")
    wavelet.write_tokens(table(spark, rows), path, BYTES, end_id=0, block_tokens=500)
    whole = _whole(BYTES)
    ordered = sorted(((r[0] is not None, r[0] or 0), _hash(r[1]), r[1] or "") for r in rows)
    want, at = [], 0
    for (known, doc), _, text in ordered:
        ids = whole(text) + bytes(4)
        want.append((doc if known else None, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = [tuple(r) for r in wavelet.read_documents(spark, path).orderBy("start").collect()]
    assert got == want
    assert wavelet.count_token(spark, path, 0).groupBy().sum("n").first()[0] == len(rows)


def test_lookups_over_files(spark, tmp_path):
    """Ids at positions and occurrences of ids, over many files and blocks, against the flat list of ids."""
    rows, path = documents(), str(tmp_path / "tokens")
    wavelet.write_tokens(table(spark, rows), path, BYTES, end_id=0, block_tokens=300)
    whole, flat = _whole(BYTES), []
    for r in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), _hash(r[1]), r[1] or "")):
        ids = np.frombuffer(whole(r[1]) + bytes(4), "<u4").tolist()
        flat += [(i, r[0], k) for k, i in enumerate(ids)]
    asked = [0, 1, 5, 299, 300, 301, len(flat) // 2, len(flat) - 1, len(flat), -1, None, 5]
    got = wavelet.token_at(spark.createDataFrame([(p,) for p in asked], "position bigint"), path, block_tokens=300)
    assert sorted(map(tuple, got.collect())) == sorted((p, flat[p][0], flat[p][1]) for p in {p for p in asked if p is not None and 0 <= p < len(flat)})
    for token in {0, flat[0][0], flat[len(flat) // 3][0], 50_255}:
        want = [(n, p, flat[p][1], flat[p][2]) for n, p in enumerate(p for p, x in enumerate(flat) if x[0] == token)]
        assert [tuple(r) for r in wavelet.occurrences(spark, path, token).orderBy("nth").collect()] == want


def test_one_id_for_most_rows_is_spread(spark, tmp_path):
    rows = spark.range(3000).selectExpr("if(id % 10 = 0, id, NULL) AS doc_id", "concat('text ', id) AS text").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wavelet.write_tokens(rows, str(tmp_path / "t"), BYTES)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).selectExpr("shard", "explode(doc_ids) AS d").groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    wavelet.write_tokens(empty, str(tmp_path / "t"), BYTES)
    assert wavelet.read_documents(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack_documents(empty, WORDS).count() == 0


@pytest.mark.parametrize(("tokens", "segments", "loss"), [(64, 256, None), (128, 3, None), (64, 8, 40), (2048, 256, None)])
def test_packing_is_whole_and_within_limits(spark, tokens, segments, loss):
    rows = documents()
    got = packing.pack_documents(table(spark, rows), WORDS, tokens=tokens, segments=segments, loss=loss).collect()
    whole = _whole(WORDS)
    ends = np.array([1], "<u4").tobytes()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(whole(r[1]) + ends)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
        assert any(zlib.crc32(x[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for x in texts[r.doc_id])
    assert sum(r.length for r in got) == sum(len(x) // 4 for many in texts.values() for x in many)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) <= tokens and len(parts) <= segments
        assert sum(r.length - (r.start == 0) for r in parts) <= (loss or tokens)
    if loss is None and segments == 256:
        assert all((n := sum(r.length for r in s)) == tokens or n & n - 1 == 0 for s in sequences.values())


def test_piece_with_few_loss_bearing_ids():
    """Instruction data: prompts bear no loss, and a sequence is bounded in what does."""
    packer = packing.Packer(tokens=20, segments=3, loss=6)
    out = []
    for k, flags in enumerate([[0] * 10 + [1] * 5, [0] * 3 + [1] * 4, [1] * 15, [0] * 30]):
        before = np.concatenate([[0], np.cumsum(flags)])
        out += list(packer.add(packing.Piece(k, 0, np.arange(len(flags), dtype="<u4").tobytes(), before)))
    out += list(packer.rest())
    assert sum(p.length for s in out for p in s) == 15 + 7 + 15 + 30
    assert all(sum(p.length for p in s) <= 20 and len(s) <= 3 and sum(p.losses for p in s) <= 6 for s in out)


def test_conversations_are_packed_under_three_limits(spark):
    """Whole turns in order, loss on the assistant's alone, and sequences that only one of the limits closes."""
    rng, whole = random.Random(8), _whole(WORDS)
    end = np.array([1], "<u4").tobytes()
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            words = rng.choice([3, 15, 60]) if t % 2 == 0 else rng.choice([2, 20, 90])
            rows.append((c, t, ["user", "assistant"][t % 2], " ".join(rng.choice(["ba", "ce", "dio", "fu"]) for _ in range(words))))
    rows += [(100, 0, "assistant", "ba " * 700), (101, 0, None, None), (None, None, None, "ba"), (None, 0, "user", "ce"), (3, 1, "assistant", "ba")]
    clash = {c: F.lit("x") for c in ("start", "length", "sequence_id", "loss", "key")}
    got = packing.pack_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns(clash), WORDS, 256, 4, 100).collect()
    total = sum(len(whole(r[3])) // 4 + 1 for r in rows)
    losses = sum(len(whole(r[3])) // 4 + 1 for r in rows if r[2] == "assistant")
    assert sum(r.length for r in got) == total and sum(r.loss_tokens for r in got) == losses
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    closed = set()
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
        sums = (sum(r.length for r in parts), len(parts), sum(r.loss_tokens for r in parts))
        assert all(x <= y for x, y in zip(sums, (256, 4, 100), strict=True))
        closed.add(tuple(x == y for x, y in zip(sums, (256, 4, 100), strict=True)))
    assert {(True, False, False), (False, False, True)} <= closed  # full of ids alone, full of loss alone
    one = [r for r in rows if r[0] == 7]
    ids = b"".join(whole(r[3]) + end for r in sorted(one, key=lambda r: r[1]))
    mine = sorted((r for r in got if r.conv_id == 7), key=lambda r: (r.turn, r.start))
    assert sum(r.length for r in mine) == len(ids) // 4
    if {r.turn for r in mine} == {0}:
        assert all(zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for r in mine)
    assert packing.pack_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"), WORDS).count() == 0
