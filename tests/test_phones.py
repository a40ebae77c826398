from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.functions.phones import AREA_CODES_3, AREA_CODES_4, national_numbers
from millrace.operators import phones
from tests.scanner import scan

CODES = {*AREA_CODES_3, *AREA_CODES_4}

# text, scanner result, older pattern's result (None: not stated)
VECTORS = [
    ("call +31 20 1234567.", ["0201234567"], ["+31201234567"]),
    ("call +31 (0)20-1234567.", ["0201234567"], ["+31201234567"]),
    ("tel 0031201234567,", ["0201234567"], ["+31201234567"]),
    ("x +31201234567\n", ["0201234567"], ["+31201234567"]),
    ("x +31201234567", [], None),
    ("+31201234567 +31101234567.", [], ["+31201234567", "+31101234567"]),
    ("a +31201234567/+31101234567.", ["0201234567", "0101234567"], ["+31201234567", "+31101234567"]),
    ("a +31 99 1234567.", [], ["+31991234567"]),
    ("a +31 44 1234567.", [], ["+31441234567"]),
    ("a +31 800 1234.", ["08001234"], []),
    ("a +31 800 1234567.", ["08001234567"], ["+31800123456"]),
    ("a +31 900 0123.", ["09000123"], []),
    ("a +310201234567.", ["0201234567"], ["+31020123456"]),
    ("a +3100201234567.", [], ["+31002012345"]),
    ("a +31201234567 8.", [], ["+31201234567"]),
    ("a 020-1234567.", [], []),
    ("a +(31)201234567.", ["0201234567"], ["+31201234567"]),
    ("a +x31201234567.", ["0201234567"], []),
    ("a +31 6 12345678 and +31 6 12345678.", ["0612345678", "0612345678"], ["+31612345678"]),
    ("a + 31 20 1234567.", ["0201234567"], ["+31201234567"]),
    ("a +31 99 9 +31 20 1234567.", ["0201234567"], None),
    ("a 9990031201234567.", ["0201234567"], []),
]


def _records(spark, texts):
    return spark.createDataFrame([(str(i), x) for i, x in enumerate(texts)], "url string, content string")


def _by_record(hits, n):
    out = [[] for _ in range(n)]
    for num, url in hits.collect():
        out[int(url)].append(num)
    return out


def test_scanner_vectors(spark):
    texts = [v[0] for v in VECTORS]
    assert _by_record(phones.phone_hits(_records(spark, texts)), len(texts)) == [v[1] for v in VECTORS]
    assert [scan(x, CODES) for x in texts] == [v[1] for v in VECTORS]


def test_old_pattern_vectors(spark):
    stated = [(v[0], v[2]) for v in VECTORS if v[2] is not None]
    hits = phones.phone_legacy(_records(spark, [x for x, _ in stated]))
    assert _by_record(hits, len(stated)) == [want for _, want in stated]


def test_extra_code(spark):
    rows = phones.phone_hits(_records(spark, ["a +31 44 1234567."]), extra_prefixes=("044",)).collect()
    assert [r.num for r in rows] == ["0441234567"]


def test_expression_equals_loop_on_random_text(spark):
    rng = random.Random(7)
    bits = ["+31", "0031", "+", "0", "00", "31", " ", "-", "(0)", "20", "6", "800", "900", "1234567", "201234567", "6 12345678", "123", "9", "x", ".", "\n", "é", "€", "+é31", "+xé31"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 14))) + rng.choice(["", ".", "\n", " "]) for _ in range(20_000)]
    got = _records(spark, texts).select(F.col("url").cast("int").alias("i"), national_numbers(F.col("content")).alias("n")).collect()
    wrong = [(texts[r.i], r.n, scan(texts[r.i], CODES)) for r in got if r.n != scan(texts[r.i], CODES)]
    assert not wrong, wrong[:5]
    assert sum(len(r.n) for r in got) > 200


def test_valid_prefix_semi_join(spark):
    nums = spark.createDataFrame([("0201234567",), ("0991234567",), ("0444123456",), ("0111234567",)], "num string")
    codes = spark.createDataFrame([("020",), ("0444",), ("044",), ("0111",)], "prefix string")
    kept = sorted(r.num for r in phones.valid_prefix(nums, codes).collect())
    assert kept == ["0111234567", "0201234567", "0444123456"]


def test_index_keeps_every_page_of_a_hot_number(spark):
    rows = [("1", f"u{i % 7}") for i in range(40)] + [("2", "v"), ("3", "w"), ("3", "w")]
    index = phones.phone_index(spark.createDataFrame(rows, "num string, url string")).collect()
    assert {(r.num, r.url): r.times for r in index} == Counter(rows)
