from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from millrace.llm import pii
from tests.llm.rows import DOCS, documents, prose, table

# The patterns as they are defined.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    return {"email": True, "card": 12 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def _base(text):
    spans = [(m.start(), k, m.end(), kind) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text or "") if _valid(kind, m.group())]
    return sorted(spans)


def _row(doc, text):
    spans = _base(text)
    written = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    return (doc, *(sum(s[3] == k for s in spans) for k in BASE), hashlib.sha256(written.encode()).hexdigest()), written


def _texts():
    rng = random.Random(4)
    bits = ["a.b@c-d.e", "@", ".", "x@y", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+31", "12", " ", "-", "é", "\n",
            "語", "_", "%", "0.0.0.0.0.0.0.0", "378282246310005", "(", ")", "z", "99999999999999999999999", "a@b.c_d@e.f"]
    return ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(3000)] + ["9" * 20_000, "1-" * 9000 + "1", "a" * 30_000 + "@", "1.1.1.1 " * 700]


def test_base_spans_are_exact(spark):
    rows = documents() + [(1000 + i, t, None, None, None) for i, t in enumerate(_texts())]
    got = pii.digest(pii.find_personal_data(table(spark, rows))).collect()
    want = {(_row(r[0], r[1])[0]) for r in rows}
    assert Counter(tuple(r)[:6] for r in got) == Counter(_row(r[0], r[1])[0] for r in rows) and len(want) > 1000
    known = {r[0]: {x for x in _row(r[0], r[1])[1].split(",") if x} for r in rows if r[0] is not None}
    assert all(known[r.doc_id] <= set(r.spans.split(",")) for r in got if r.doc_id is not None)


def _contexts():
    """Mails after 'contact me at'; the same words before handles that no pattern knows; the handles elsewhere too."""
    rng = random.Random(7)
    rows = [(i, f"{prose(rng, 10)} contact me at u{i}.x@mail.example.org now {prose(rng, 5)}", None, None, None) for i in range(12)]
    rows += [(100, f"{prose(rng, 8)} contact me at handle77 now {prose(rng, 4)}", None, None, None)]
    rows += [(101, f"{prose(rng, 8)} contact me at handle77 today", None, None, None), (102, f"{prose(rng, 8)} wrote handle77 yesterday", None, None, None)]
    rows += [(200 + i, f"{prose(rng, 8)} order number{i}00 shipped", None, None, None) for i in range(12)]
    return rows


def test_contexts_of_seeds_discover_other_identifiers(spark):
    rows = _contexts()
    found = {r.doc_id: r for r in pii.find_personal_data(table(spark, rows)).collect()}
    new = {d: r.instances for d, r in found.items() if r.instances}
    assert new == {100: ["handle77"], 101: ["handle77"], 102: ["handle77"]}
    span = next(s for s in found[102].spans)
    assert rows[14][1][span.start : span.end] == "handle77" and pii.KINDS[span.kind] == "email" and not found[102].base


def test_separated_identifiers_are_instances(spark):
    whole = ["123-45-6789", "555-123-4567", "020 7946 0958", "(555) 123-4567", "ABCDEF-12345", "A1234", "EMP-004512", "GB29 NWBK 6016 1331 9268 19",
             "handle77", "4111 1111 1111 1111", "12-AB-3456", "123-456-AB7", "10.20.30.40", "+31 20 555 7713", "a.b@c.d"]
    texts = [f"so {x} it was" for x in whole] + ["at 10am on 12 may, well-known", "a@b.c_d12345", "a-" * 40_000, "1-" * 40_000 + "x", "1 " * 40_000 + "1-1x"]
    got = [r.m for r in spark.createDataFrame(enumerate(texts), "i int, t string").select("i", pii.matches(pii.F.col("t"), pii.INSTANCE).alias("m")).orderBy("i").collect()]
    n = len(whole)
    assert got[:n] == [[x] for x in whole] and got[n : n + 3] == [[], ["a@b.c", "d12345"], []]
    assert got[n + 3] == [texts[n + 3]] and got[n + 4] == ["1 " * 39_999 + "1"]


def _card(i):
    digits = f"4{i:03d}0011223344{i % 10}"
    digits += next(str(c) for c in range(10) if _luhn(digits + str(c)))
    return " ".join(digits[k : k + 4] for k in range(0, 16, 4))


def test_addresses_cards_and_phones_are_seeds(spark):
    """Identifiers in the places of IPv4 addresses, cards in blocks and phones are found; a second round needs the first."""
    rng = random.Random(8)
    seeds = {1: ("traffic from node", lambda i: f"10.0.{i}.7"), 2: ("charge the card", _card), 3: ("ring the number", lambda i: f"+1 (017) 555-77{i + 10}")}
    new = {"db-node-17": 1, "ABCDEF-12345": 2, "123-45-6789": 2, "555-123-4567": 3, "020 7946 0958": 3}
    texts = [f"{prose(rng, 9)} {words} {of(i)} today {prose(rng, 5)}" for words, of in seeds.values() for i in range(12)]
    texts += [f"{prose(rng, 9)} {seeds[k][0]} {x} today {prose(rng, 5)}" for x, k in new.items()]
    # The two numbers and one of their kind stand in other words: three known there are found only after a round.
    texts += [f"{prose(rng, 9)} patient file {x} closed" for x in ("123-45-6789", "555-123-4567", "020 7946 0958", "db-node-17", "ABCDEF-12345", "987-65-4321")]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = pii.find_personal_data(table(spark, rows)).collect()
    got = {(rows[r.doc_id][1][s.start : s.end], s.kind) for r in found for s in r.spans if s not in r.base}
    assert got == {*new.items(), *((x, k) for x, k in got if x == "987-65-4321")} and len(got) == len(new) + 1
    texts = [r.text for r in pii.masked(table(spark, rows)).collect()]
    assert not any(x in t for t in texts for x in [*new, "987-65-4321"])


def test_rounds_go_on_until_nothing_is_added(spark):
    """A chain: each identifier is known only by the words it shares with those before it."""
    sizes = [40, 24, 14, 8, 4, 1]
    names = [(f"code{k + d}-{x}", k) for k in range(5) for d in (0, 1) for x in range(sizes[k + d])]
    rows = [(name, 0 if name.startswith("code0") else None, f"l:{k}", f"b:{k}") for name, k in names]
    got = {r.instance for r in pii.discovered(spark.createDataFrame(rows, "instance string, kind int, left string, beside string")).collect()}
    assert got == {r[0] for r in rows if r[1] is None}


def test_masking(spark):
    rows = _contexts() + documents() + [(500, "a@b.c, 1.2.3.4; 4111111111111111 +1 (017) 555-7713; 4111111111111112", None, None, None), (None, "x@y.z", None, None, None)]
    docs = table(spark, rows)
    got = pii.masked(docs)
    assert got.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in got.collect())
    assert texts[500, "[EMAIL], [IP]; [CARD] [PHONE]; 4111111111111112"] == 1 and texts[None, "[EMAIL]"] == 1
    plain = [r for r in rows if not _base(r[1]) and "handle77" not in (r[1] or "")]
    assert all(texts[r[0], r[1]] for r in plain) and sum(texts.values()) == len(rows)
    assert not any("handle77" in (t or "") for _, t in texts)


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pii.digest(pii.find_personal_data(empty)).count() == 0 and pii.masked(empty).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.find_personal_data(spark.createDataFrame(documents(), DOCS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
