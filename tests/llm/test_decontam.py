from __future__ import annotations

import random

import pytest

from millrace.llm import decontam
from tests.llm.rows import DOCS, documents, prose, table


def _least_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def _damaged(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.33:
            out[at] = rng.choice("abcdefg")
        elif kind < 0.66:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdefg"))
    return "".join(out)


def test_every_item_within_its_budget_is_found(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, rng.randint(10, 22))) for i in range(12)]
    rows = []
    for k in range(60):
        item = items[k % 12][1]
        rows.append((k, f"{prose(rng, 15)} {_damaged(rng, item, rng.randint(0, len(item) // 7))} {prose(rng, 15)}", None, None, None))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = {}
    for d, text, *_ in rows:
        for i, item in items:
            m, body = decontam.normal(item), decontam.normal(text)
            edits = _least_edits(m, body)
            if edits <= decontam.edit_budget(len(m)):
                want[d, i] = edits
    for block in (decontam.BLOCK_BYTES, 300):  # one block, and many
        got = decontam.contaminated(docs, bench, block).collect()
        assert {(r.doc_id, r.item_id): r.edits for r in got} == want and len(got) == len(want)
    assert 20 < len(want) < 60
    texts, passages = {r[0]: decontam.normal(r[1]) for r in rows}, {i: decontam.normal(t) for i, t in items}
    assert all(_least_edits(passages[r.item_id], texts[r.doc_id][r.start : r.end]) == r.edits for r in got)
    left = decontam.without_contaminated(docs, bench, 300).collect()
    assert sorted(r.doc_id for r in left) == sorted({r[0] for r in rows} - {d for d, _ in want})


def test_case_marks_and_space_do_not_matter(spark):
    rng = random.Random(3)
    item = prose(rng, 15)
    shouted = "!! ".join(item.upper().split())
    docs = spark.createDataFrame([(1, f"Ab. {shouted}!!\n\nend", None, None, None), (2, " ".join(item.split()[:7]), None, None, None)], DOCS)
    got = decontam.contaminated(docs, spark.createDataFrame([(5, item), (6, item)], "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in got) == [(1, 5, 0), (1, 6, 0)]


@pytest.mark.parametrize("bench", [[], [(None, "x" * 90), (1, None), (2, ""), (3, "too short")]])
def test_odd_rows(spark, bench):
    rows = documents()
    items = spark.createDataFrame(bench, "item_id bigint, text string")
    assert decontam.contaminated(table(spark, rows), items).count() == 0
    assert decontam.without_contaminated(table(spark, rows), items).count() == len(rows)
    one = spark.createDataFrame([(9, rows[0][1])], "item_id bigint, text string")
    left = decontam.without_contaminated(table(spark, rows), one)
    assert left.columns == table(spark, rows).columns and left.count() == len(rows) - 2  # the row and its repeat
    assert decontam.contaminated(spark.createDataFrame([], DOCS), one).count() == 0


def test_periodic_text():
    item = decontam.normal("ab cd ef gh " * 6)
    held = decontam.Items([(1, item)])
    assert held.matches("ab cd ef gh " * 400)[0][1] == 0 and held.matches("ab cd " * 400) == []


def test_short_items_are_found_exactly(spark):
    """Items too short for q-grams are no longer left out: their words must stand in the text, without edits."""
    items = [(1, "Paris!"), (2, "the blue whale"), (None, "a small  NULL id"), (4, " ?! "), (5, None), (6, "blue"), (7, "Paris")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = ["I saw The Blue, whale in paris.", "the blue whales", "parish", "x a small null ID y", "", None, "blue" * 3]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = sorted((r.doc_id, -1 if r.item_id is None else r.item_id, r.edits, r.start, r.end) for r in decontam.contaminated(docs, bench).collect())
    assert got == [(0, 1, 0, 24, 29), (0, 2, 0, 6, 20), (0, 6, 0, 10, 14), (0, 7, 0, 24, 29), (1, 6, 0, 4, 8), (3, -1, 0, 2, 17)]
    assert sorted(r.doc_id for r in decontam.without_contaminated(docs, bench).collect()) == [2, 4, 5, 6]
    rng = random.Random(3)
    long = prose(rng, 30)
    both = spark.createDataFrame([(1, long), (2, "zq zq")], "item_id bigint, text string")
    rows = spark.createDataFrame([(1, f"x {long} zq zq", None, None, None), (2, prose(rng, 40), None, None, None)], DOCS)
    assert sorted((r.doc_id, r.item_id) for r in decontam.contaminated(rows, both).collect()) == [(1, 1), (1, 2)]
