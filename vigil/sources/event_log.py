"""Event-log scans (S1, S2, S6) and appends.

The event log is the bronze table: one row per event with the progress
document kept as JSON text in ``details``.  At rest it is parquet partitioned
by ``event_date`` so retention drops whole partitions and time filters prune
directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import schemas

BRONZE_COLUMNS = [f.name for f in schemas.EVENT_LOG.fields]


def bronze_events(log: DataFrame) -> DataFrame:
    """The nine event-log columns, nothing else (column pruning reaches
    the parquet scan)."""
    return log.select(*BRONZE_COLUMNS)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of a stored event log with its fixed schema."""
    return bronze_events(spark.read.schema(_with_partition(schemas.EVENT_LOG_READ)).parquet(path))


def read_event_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The event log as a stream (file source, explicit schema)."""
    r = spark.readStream.schema(_with_partition(schemas.EVENT_LOG_READ))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return bronze_events(r.parquet(path))


def with_event_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.col(ts)))


def append_event_log(df: DataFrame, path: str) -> None:
    """Append bronze rows, partitioned by day.  Rows of one flush are written
    by as many tasks as the data has partitions; compaction (K9) merges small
    files later."""
    with_event_date(bronze_events(df)).write.mode("append").partitionBy("event_date").parquet(path)


def _with_partition(schema):
    from pyspark.sql.types import DateType, StructField, StructType

    return StructType(schema.fields + [StructField("event_date", DateType(), True)])
