"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int", "boolean": "bool", "hugeint": "HUGEINT"}.get(name, name)


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def compare(got, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """A description of the first difference between a Spark DataFrame and a query, or None."""
    rel = con.sql(sql)
    names = sorted(got.columns)
    if names != sorted(rel.columns):
        return f"columns {names} != {sorted(rel.columns)}"
    want_types = dict(zip(rel.columns, (_kind(str(x)) for x in rel.types), strict=True))
    got_types = {n: {"boolean": "bool"}.get(x, x) for n, x in got.dtypes}
    if got_types != want_types:
        return f"types {[(n, got_types[n], want_types[n]) for n in names if got_types[n] != want_types[n]]}"
    order = [rel.columns.index(n) for n in names]
    want = Counter(tuple(_value(row[i]) for i in order) for row in rel.fetchall())
    have = Counter(tuple(_value(v) for v in row) for row in got.select(*[f"`{n}`" for n in names]).collect())
    if want != have:
        extra, missing = list((have - want).items())[:3], list((want - have).items())[:3]
        return f"rows {sum(have.values())} vs {sum(want.values())}; only Spark {str(extra)[:400]}; only SQL {str(missing)[:400]}"
    return None
