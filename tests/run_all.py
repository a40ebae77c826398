"""Compare all registered queries (or those named) at one scale: ``python -m tests.run_all <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from millrace.session import session
from tests.harness import compare, connect

if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:]
    spark = session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        began = time.perf_counter()
        try:
            problem = compare(fn(spark, sf), oracles[name], connect(sf)) if name in oracles else f"no SQL, {fn(spark, sf).count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{name:24s} {time.perf_counter() - began:6.1f}s  {problem or 'ok'}", flush=True)
