"""Progress and metrics of running jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def job_metrics(df: DataFrame, name: str, **failed) -> tuple[DataFrame, Observation]:
    """``df`` with a row count, and one count per condition, observed while it is used; read them with ``.get``."""
    seen = Observation(name)
    counts = [F.count_if(condition).alias(label) for label, condition in failed.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


class Progress(StreamingQueryListener):
    """Totals over all queries of a session: batches, input rows, rows that came too late for their windows, failures.

    Late rows are counted as Spark's state operators do: after the rows of a batch have been added up by window and key.
    """

    def __init__(self) -> None:
        self.batches = self.rows = self.late = self.failed = self.running = 0

    def onQueryStarted(self, event) -> None:
        self.running += 1

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += event.progress.numInputRows
        self.late += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.running -= 1
        self.failed += event.exception is not None


def drain(query: StreamingQuery) -> None:
    """Stop after everything that has arrived is processed."""
    query.processAllAvailable()
    query.stop()
