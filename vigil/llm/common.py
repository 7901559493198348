"""Helpers shared by the operators of this subpackage.

Scratch tables: Parquet folders under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``).  They cut lineage (a lost executor re-reads the
table instead of recomputing the job) and are deterministic to rebuild.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to a Python worker: long texts make 10 000
#: rows too large for a worker's memory.
ARROW_ROWS = 1000
ARROW_BYTES = 16 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python tasks of this session receive."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


class Scratch:
    """Parquet tables in a fresh sub folder of the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{name}-{self._n}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the table read back (``scratch_path`` names it)."""
        p = self.path(name)
        df.write.mode("overwrite").parquet(p)
        out = self.spark.read.schema(df.schema).parquet(p)
        out.scratch_path = p
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        p = getattr(df, "scratch_path", None)
        if p:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def chunks(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive runs of ``items`` whose weights sum to about ``limit``."""
    run, total = [], 0
    for x in items:
        run.append(x)
        total += weight(x)
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run


def broadcast_if_small(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within
    ``max_rows``; else as it is, for Spark's shuffled join."""
    return F.broadcast(df) if rows <= max_rows else df


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
