"""Small tables with the odd rows that every operator must take: NULLs, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOWELS, CONSONANTS = "aeiou", "bcdfghklmnprst"


def prose(rng: random.Random, n: int, letters: str = CONSONANTS) -> str:
    word = lambda: "".join(rng.choice(letters) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4)))
    return " ".join(word() for _ in range(n))


def documents(seed: int = 1, n: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, letters = [("aa", "bcdfg"), ("bb", "hklmn"), ("cc", "prstv")][i % 3]
        rows.append([i, prose(rng, rng.randint(25, 90), letters), lang, f"host{i % 4}", 0])
    rows[5][1] = rows[4][1]  # a copy
    rows[7][1] = " ".join([*rows[6][1].split()[:-1], "zz"])  # a near copy
    rows.append(list(rows[0]))  # a repeated row
    rows += [[None, None, None, None, None], [n, None, "aa", "host0", 0], [n + 1, "", "bb", None, 0], [None, prose(rng, 30), None, "host1", 0]]
    rows += [[n + 2, prose(rng, 6000), "cc", "host2", 0], [n + 3, "one", None, "host3", 3], [n + 4, " \n\t ", "aa", "host3", 4]]
    return [tuple(r) for r in rows]


def table(spark, rows: list[tuple]):
    """``documents`` with extra columns whose names clash with those of results and of steps inside."""
    from pyspark.sql import functions as F

    clash = ["kept", "score", "shard", "size", "id", "n", "bucket", "component_id", "h", "spans", "start", "row"]
    return spark.createDataFrame(rows, DOCS).repartition(3).withColumns({c: F.lit("x") for c in clash})
