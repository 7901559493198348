"""Progress event log derived from an application event table.

Treats every ``event_type`` of the ``events`` table as one streaming query
that processes one micro-batch per hour of data, and writes down the
progress event that query would have reported, in the event-log format of
the listener (bronze).  All figures are integer-derived, so any SQL engine
recomputes them exactly.  Error events become ERROR / WARN rows of the
stream they are attributed to; usage rows (infrastructure) and sensor rows
come from the same table.

The aggregation is a plain ``groupBy`` (partial aggregation before the
shuffle), so its cost grows with the event table while the log stays one row
per (stream, hour).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from vigil import config as C
from vigil import schemas
from vigil.functions.core import event_id

# ---------------------------------------------------------------------------
# Fixed values of the progress-log fixture (shared with the SQL oracle).
# ---------------------------------------------------------------------------
EPOCH = 1704067200                      # 2024-01-01 00:00:00 UTC, batch 0 starts
BATCH_SECONDS = 3600                    # one micro-batch per hour of data
STREAM_TYPES = ["click", "error", "purchase", "signup", "view"]
STATELESS_TYPE = "view"                 # reports no state operators
NO_QUALITY_TYPE = "signup"              # reports observedMetrics = {}
EXCEPTION_TYPES = ["StreamingQueryException", "SparkException", "IOException"]
WORKSPACE_ID = "ws-0001"
JOB_ID = "job-0001"
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _ts(c: str = "ts") -> Column:
    return F.col(c).cast("timestamp")


def batch_number(ts: Column) -> Column:
    return ((F.unix_timestamp(ts) - F.lit(EPOCH)) / F.lit(BATCH_SECONDS)).cast("bigint")


def batch_end(bn: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH) + (bn + 1) * F.lit(BATCH_SECONDS))


def micro_batches(events: DataFrame) -> DataFrame:
    """One row per (event_type, hour): the micro-batch statistics."""
    ts = _ts()
    tr = F.date_trunc("MILLISECOND", ts)
    return events.groupBy(F.col("event_type"), batch_number(ts).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("bigint").alias("cents"),
        F.count_distinct("user_id").alias("nu"),
        F.sum(F.when(F.col("value") < 1, 1).otherwise(0)).cast("bigint").alias("small"),
        F.sum(F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)).cast("bigint").alias("late"),
        F.min(tr).alias("tmin"),
        F.max(tr).alias("tmax"),
    )


def _iso(c: Column) -> Column:
    return F.date_format(c, ISO_MS)


def _progress_details(mb: DataFrame) -> Column:
    t = F.col("event_type")
    n, cents, nu = F.col("n"), F.col("cents"), F.col("nu")
    bts = batch_end(F.col("batch_id"))
    so_type = ArrayType(schemas.STATE_OPERATOR)
    state_ops = F.when(t == STATELESS_TYPE, F.array().cast(so_type)).otherwise(
        F.array(
            F.struct(
                F.lit("stateStoreSave").alias("operatorName"),
                n.alias("numRowsTotal"),
                n.alias("numRowsUpdated"),
                (cents * 1024).alias("memoryUsedBytes"),
                F.lit(0).cast("bigint").alias("numRowsDroppedByWatermark"),
            ),
            F.struct(
                F.lit("dedupe").alias("operatorName"),
                F.when(n % 5 == 0, F.lit(None).cast("bigint")).otherwise(nu).alias("numRowsTotal"),
                F.lit(0).cast("bigint").alias("numRowsUpdated"),
                (n * 4096).alias("memoryUsedBytes"),
                F.lit(0).cast("bigint").alias("numRowsDroppedByWatermark"),
            ),
        ).cast(so_type)
    )
    event_time = F.when(n % 6 == 0, F.lit(None)).otherwise(
        F.struct(
            _iso(F.col("tmax")).alias("max"),
            _iso(F.col("tmin")).alias("min"),
            _iso(F.col("tmax") - F.expr("INTERVAL 30 SECONDS")).alias("watermark"),
        )
    )
    quality = F.when(t == NO_QUALITY_TYPE, F.lit(None).cast(schemas.QUALITY)).otherwise(
        F.struct(
            ((n - nu) / n.cast("double")).alias("duplicate_rate"),
            F.col("small").alias("dropped_record_count"),
            (F.col("late") / n.cast("double")).alias("late_record_percentage"),
            F.create_map(F.lit("value"), F.col("small") / n.cast("double")).alias("null_rate_by_column"),
            (F.col("batch_id") % 24 == 5).alias("schema_change_detected"),
        )
    )
    progress = F.struct(
        F.concat(F.lit("q-"), t).alias("id"),
        F.concat(F.lit("r-"), t).alias("runId"),
        F.concat(F.lit("Stream "), t).alias("name"),
        _iso(bts).alias("timestamp"),
        F.col("batch_id").alias("batchId"),
        cents.alias("batchDuration"),
        n.alias("numInputRows"),
        (n / F.lit(3600.0)).alias("inputRowsPerSecond"),
        (cents / F.lit(18000000.0)).alias("processedRowsPerSecond"),
        F.create_map(F.lit("addBatch"), cents, F.lit("triggerExecution"), cents).cast(MapType(schemas.S, schemas.L)).alias("durationMs"),
        event_time.alias("eventTime"),
        state_ops.alias("stateOperators"),
        F.array(F.struct(F.lit("events").alias("description"), n.alias("numInputRows"))).alias("sources"),
        F.struct(F.lit("parquet").alias("description"), n.alias("numOutputRows")).alias("sink"),
        F.struct(quality.alias("quality")).alias("observedMetrics"),
    )
    return F.to_json(F.struct(progress.alias("stream_progress")))


def _origin(flow_id: Column, flow_name: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit(WORKSPACE_ID).alias("workspace_id"),
            F.lit(JOB_ID).alias("job_id"),
            flow_name.alias("flow_name"),
            flow_id.alias("flow_id"),
        )
    )


def progress_events(events: DataFrame) -> DataFrame:
    """Bronze ``stream_progress`` rows, one per (stream, hour)."""
    mb = micro_batches(events)
    t = F.col("event_type")
    qid = F.concat(F.lit("q-"), t)
    qname = F.concat(F.lit("stream_"), t)
    return mb.select(
        event_id(F.lit("progress"), qid, F.col("batch_id")).alias("id"),
        F.to_json(F.struct(F.col("batch_id").alias("batch_id"))).alias("sequence"),
        _origin(qid, qname).alias("origin"),
        batch_end(F.col("batch_id")).alias("timestamp"),
        F.format_string(C.PROGRESS_MESSAGE, qname, F.col("batch_id")).alias("message"),
        F.lit("METRICS").alias("level"),
        F.lit("stream_progress").alias("event_type"),
        F.lit("STABLE").alias("maturity_level"),
        _progress_details(mb).alias("details"),
    )


def error_events(events: DataFrame) -> DataFrame:
    """Bronze ERROR / WARN rows from the table's ``error`` events."""
    err = events.filter(F.col("event_type") == "error")
    target = F.element_at(F.array(*[F.lit(s) for s in STREAM_TYPES]), (F.col("user_id") % 5 + 1).cast("int"))
    is_err = F.col("event_id") % 2 == 0
    level = F.when(is_err, "ERROR").otherwise("WARN")
    exc = F.element_at(F.array(*[F.lit(s) for s in EXCEPTION_TYPES]), (F.col("event_id") % 3 + 1).cast("int"))
    ts = F.date_trunc("MILLISECOND", _ts())
    detail = F.struct(
        F.struct(
            batch_number(_ts()).alias("batch_id"),
            exc.alias("exception_type"),
            F.concat(F.lit("error event "), F.col("event_id").cast("string")).alias("message"),
            F.when(is_err, "QUERY_FAILED").otherwise("RETRYABLE").alias("termination_reason"),
            F.when(is_err, F.concat(F.lit("at batch "), batch_number(_ts()).cast("string"))).alias("stack_trace"),
        ).alias("error")
    )
    qid = F.concat(F.lit("q-"), target)
    return err.select(
        event_id(F.lit("error"), F.col("event_id")).alias("id"),
        F.to_json(F.struct(batch_number(_ts()).alias("batch_id"))).alias("sequence"),
        _origin(qid, F.concat(F.lit("stream_"), target)).alias("origin"),
        ts.alias("timestamp"),
        F.concat(F.lit("error event "), F.col("event_id").cast("string")).alias("message"),
        level.alias("level"),
        F.lit("stream_error").alias("event_type"),
        F.lit("STABLE").alias("maturity_level"),
        F.to_json(detail).alias("details"),
    )


def event_log_from_events(events: DataFrame) -> DataFrame:
    """The full bronze log: progress rows plus error rows."""
    return progress_events(events).unionByName(error_events(events))


# ---------------------------------------------------------------------------
# Infrastructure samples and usage rows from the same table.
# ---------------------------------------------------------------------------
CLUSTERS = 8


def cluster_samples(events: DataFrame, environment: str = "prod") -> DataFrame:
    """One infrastructure sample per event: cluster = user_id mod 8, CPU =
    min(value, 100), memory and executor count from the event id, DBU =
    value / 100 (missing for every 11th event).  ``autoscaling_event`` is
    left null; ``operators.infra.autoscale_events`` derives it."""
    eid = F.col("event_id")
    return events.select(
        F.concat(F.lit("c-"), (F.col("user_id") % CLUSTERS).cast("string")).alias("cluster_id"),
        _ts().alias("timestamp"),
        F.least(F.col("value"), F.lit(100.0)).alias("cpu_usage_percent"),
        ((eid * 37) % 101).cast("double").alias("memory_usage_percent"),
        ((eid * 7919) % 10 + 1).cast("int").alias("executor_count"),
        F.lit(None).cast("string").alias("autoscaling_event"),
        F.when(eid % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value") / 100).alias("dbu_consumption"),
        F.lit("driver-std").alias("driver_node_type"),
        F.lit("worker-std").alias("worker_node_type"),
        F.lit(environment).alias("environment"),
        F.lit(WORKSPACE_ID).alias("workspace_id"),
        F.current_timestamp().alias("ingestion_ts"),
        eid.alias("sample_id"),
    )


def usage_rows(events: DataFrame) -> DataFrame:
    """Billing-usage shaped rows: usage_date, usage_metadata.cluster_id (null
    for every 13th event: usage not tied to a cluster), usage_quantity."""
    eid = F.col("event_id")
    cid = F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c-"), (F.col("user_id") % CLUSTERS).cast("string")))
    return events.select(
        _ts().alias("usage_date"),
        F.struct(cid.alias("cluster_id")).alias("usage_metadata"),
        (F.col("value") / 3).alias("usage_quantity"),
        F.lit(WORKSPACE_ID).alias("workspace_id"),
        eid.alias("record_id"),
    )
