"""Intermediate tables in the cluster's shared checkpoint folder.

A written table cuts lineage, is computed once, survives the loss of any
executor, and gives the optimizer true file sizes, so that a later join is
broadcast only when the table really is below the session's threshold.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes = threading.local()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the context.

    Where neither is set, intermediates go below the warehouse.  A warehouse in a local folder is refused on a cluster, as
    executors on other machines would not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share, not {folder}")
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the checkpoint folder and return a scan of what was written.

    The table stays until ``release``, or until the enclosing ``scratch`` block ends.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """``materialize`` in ``buckets`` files by a hash of ``column``: joins and groupings on it need no shuffle of these rows.

    Spark keeps bucketing in its catalog, so the table has a name there until the application ends or drops it.
    """
    path, name = fresh_path(df.sparkSession, label), f"millrace_{label}_{uuid.uuid4().hex}"
    df.repartition(buckets, column).write.bucketBy(buckets, column).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the checkpoint folder, removed with the intermediate tables."""
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_scopes, "open", []):
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables materialized inside the block when it ends; results must be written by then."""
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        yield
    finally:
        *_scopes.open, paths = _scopes.open
        for path in paths:
            remove(spark, path)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application."""
    remove(spark, _own_folder(spark))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The whole numbers ``n`` of the folders ``<column>=<n>`` below ``path``; none where it does not exist."""
    if not exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]
    return [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=")]


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/millrace/{spark.sparkContext.applicationId}"
