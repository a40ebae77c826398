"""Processing of named chunks as their markers arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.external import pipe_chunks
from millrace.operators.reads import chunk_id


def stream_chunks(
    markers: DataFrame, chunks: str, cmd: Sequence[str], out: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Run ``cmd`` over each chunk that a marker names; results are ``out/batch=<n>``.

    ``chunks`` is a ``write_chunks`` folder.  Only the folders of the named chunks
    are read, and a batch that runs again replaces its own results.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        # The chunks that one batch of markers names, as literals: the scan then lists their folders only.
        names = [r.chunk for r in chunk_id(batch).filter(F.col("chunk").isNotNull()).select("chunk").distinct().collect()]
        rows = batch.sparkSession.read.parquet(chunks).filter(F.col("chunk").isin(names))
        record = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual")
        piped = pipe_chunks(rows.select("chunk", "slot", record.alias("line")), "chunk", cmd, order="slot")
        piped.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = markers.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def chunk_progress(markers: DataFrame, results: DataFrame) -> DataFrame:
    """One row: chunks ``submitted``, ``processed`` and ``successful`` (exit code 0)."""
    named = chunk_id(markers).select("chunk").distinct()
    done = results.groupBy("chunk").agg(F.min("exit_code").alias("exit_code"))
    return named.join(done, "chunk", "left").agg(
        F.count("*").alias("submitted"), F.count("exit_code").alias("processed"), F.count_if(F.col("exit_code") == 0).alias("successful")
    )
