"""Ids and texts of the merge rounds against the library's own."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import subwords
from tests.llm.rows import documents, table

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return subwords.Pieces(PATH)


def _same(own, lib, texts):
    got = own.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == lib.encode(text or ""), text[:80]
        assert own.decode(ids) == lib.decode(lib.encode(text or ""))


def test_odd_texts(own, lib):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyzABC  \n\t▁éüñßж漢字日本語😀𐍈́‍.,0123\x00\x01﻿"
    _same(own, lib, ["".join(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(1500)])
    names = [lib.id_to_piece(i) for i in range(259, lib.vocab_size())]
    _same(own, lib, ["".join(rng.choice(names) for _ in range(rng.randint(0, 50))) for _ in range(1500)])
    _same(own, lib, ["".join(rng.choice("ainst") for _ in range(rng.randint(0, 300))) for _ in range(500)])
    _same(own, lib, ["", None, " ", "  ", "</s><s><unk>", "<0x41>", "퟿"])


def test_runs_and_long_texts(own, lib):
    _same(own, lib, [c * k for c in "a e0=-_.\n漢ин" for k in (1, 2, 3, 5, 8, 15, 16, 17, 33, 100, 1000, 3000)])
    rng = random.Random(2)
    _same(own, lib, ["".join(rng.choice("aeiou=-") for _ in range(60_000)), " " * 20_000, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(50_000))])


def test_rounds_and_the_heap_agree(own):
    rng = random.Random(3)
    for _ in range(300):
        text = "▁" + "".join(rng.choice("ainstre") for _ in range(rng.randint(0, 40)))
        symbols = own.letter[[ord(c) for c in text]].astype(np.int64)
        rounds, _ = own.merge(symbols, np.zeros(len(symbols), np.int64))
        assert rounds.tolist() == own.merge_one(symbols.tolist())


def test_small_memory(lib, monkeypatch):
    monkeypatch.setattr(subwords, "PARTS", 50)
    monkeypatch.setattr(subwords, "TOGETHER", 64)
    small = subwords.Pieces(PATH)
    for k in range(5):
        _same(small, lib, [r[1] for r in documents(k) if r[1]])


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(text):
    own, lib = subwords.kept_pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH) if not hasattr(test_any_text, "lib") else test_any_text.lib
    test_any_text.lib = lib
    assert own.encode([text])[0].tolist() == lib.encode(text)


def test_ids_that_no_text_has(own, lib):
    rng = random.Random(5)
    for _ in range(4000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3 + 0xC2, 3 + 0xF4), rng.randint(3 + 0x80, 3 + 0xBF), rng.randint(259, 31999), 259, 263])
               for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(ids, np.int64)) == lib.decode(ids)


def test_rows(spark, lib):
    rows = documents()
    got = sorted(tuple(r) for r in subwords.digests(table(spark, rows), PATH).fillna({"doc_id": -1}).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(r[0], lib.encode(r[1] or "")) for r in rows]
    assert got == sorted((-1 if d is None else d, len(x), sha(",".join(map(str, x))), sha(lib.decode(x))) for d, x in ids)
    encoded = subwords.encoded(table(spark, rows), PATH)
    back = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in subwords.decoded(encoded, PATH).collect())
    assert back == sorted((-1 if r[0] is None else r[0], r[1] or "") for r in rows)
    assert subwords.digests(table(spark, rows).limit(0), PATH).count() == 0
