from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.rows import DOCS, documents, prose, table


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with copies, a near copy, a benchmark passage, personal data, blank and foreign texts."""
    folder = tmp_path_factory.mktemp("corpus")
    rng = random.Random(21)
    rows = [(r[0], r[1], r[2] or "aa", r[3], r[4]) if r[0] is not None and r[0] < 40 else r for r in documents(1, 40)]
    rows = [r for r in rows if r[0] is not None]
    item = prose(rng, 20)
    rows += [(300, f"{prose(rng, 20, 'bcdfg')} {item.upper()} {prose(rng, 20, 'bcdfg')}", "aa", "host0", 0)]
    rows += [(301, prose(rng, 30, "bcdfg") + " mail a.b@c.example.org end", "aa", "host0", 0), (302, "日本語の文章です" * 9, None, "host9", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows


def test_stages_one_after_another(spark, corpus, tmp_path):
    folder, rows = corpus
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        left[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    ids = sorted(r[0] for r in rows)
    blank = {r[0] for r in rows if not (r[1] or "").strip()}
    assert left["language_id"] == [i for i in ids if i not in blank | {302}]
    deduped = sorted({*left["language_id"]} - {5, 7})  # row 0 was repeated, 5 is a copy, 7 a near copy
    assert left["near_dedup"] == deduped
    assert left["decontamination"] == left["personal_data"] == [i for i in deduped if i != 300]
    masked = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert masked[301].text.endswith("mail [EMAIL] end") and masked[301].n_chars == len(masked[301].text)

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = {d: np.array(t.encode(r.text, add_special_tokens=False).ids + [1], "<u4").tobytes() for d, r in masked.items()}
    pieces = docs.collect()
    assert all(zlib.crc32(coded[p.doc_id][4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for p in pieces)
    assert sum(p.length for p in pieces) == sum(len(x) // 4 for x in coded.values())


def test_stages_take_odd_rows(spark, tmp_path):
    """NULL ids and columns, repeated rows, blank and long texts, further columns with clashing names, and no rows at all."""
    rng = random.Random(3)
    rows = documents(1, 30) + [(None, prose(rng, 30, "bcdfg"), "aa", "host0", 1), (None, prose(rng, 30, "bcdfg"), "aa", None, None), (3, prose(rng, 25, "prstv"), "cc", "h", 2)]
    spark.createDataFrame([(None, None), (1, ""), (2, prose(rng, 20))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = table(spark, rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0, name
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(k)))
        left = spark.read.parquet(str(tmp_path / str(k)))
        assert left.filter("doc_id IS NULL").count() >= 2, name  # rows without an id are judged each by itself
        docs = left


def test_a_repeated_row_stays_as_the_least_of_its_kind(spark):
    rows = [(1, "one two three four five six", lang, src, 5) for lang, src in (("b", "x"), ("a", "z"), ("a", "y"), (None, "q"))]
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(order, DOCS).repartition(2), "").collect()
        assert [tuple(r) for r in got] == [(1, "one two three four five six", None, "q", 5)]


def test_run_gives_the_rows_of_the_stages(spark, corpus, tmp_path):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    whole = lambda df: sorted((r[0], sum(x[2] for x in key(df) if x[0] == r[0])) for r in key(df))
    assert dict(whole(corpus_pipeline.run(spark, folder))) == dict(whole(docs))


def test_all_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(QUERIES) <= names and set(ORACLES) <= set(entry.oracle_sql())
