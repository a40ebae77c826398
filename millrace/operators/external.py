"""Running an external command once per chunk of rows."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "exit_code int, stdout string, stderr string"


def pipe_chunks(df: DataFrame, key: str, cmd: Sequence[str] | Callable[[object], Sequence[str]], order: str, line: str = "line") -> DataFrame:
    """``key, exit_code, stdout, stderr``: the lines of each chunk, in order, through ``cmd``.

    A chunk is one process' input and must be bounded by how it was cut, as
    ``interleave_chunks`` does.  ``cmd`` may be a function of the chunk's key.
    A command that fails is reported in its row; the others go on.
    """

    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        value = chunk[key].iloc[0]
        argv = list(cmd(value) if callable(cmd) else cmd)
        text = "".join(f"{x}\n" for x in chunk.sort_values(order)[line])
        try:
            done = subprocess.run(argv, input=text, capture_output=True, text=True, check=False)
            code, out, err = done.returncode, done.stdout, done.stderr
        except OSError as problem:
            code, out, err = 127, "", str(problem)
        return pd.DataFrame({key: [value], "exit_code": [code], "stdout": [out], "stderr": [err]})

    key_type = dict(df.dtypes)[key]
    return df.select(key, order, line).groupBy(key).applyInPandas(run, f"{key} {key_type}, {RESULT}")
