"""Canonical schemas: event log (bronze), progress document, silver tables.

Column names, order, types and nullability follow the table DDL of the
reference (resolving writer/DDL mismatches in favour of the DDL).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, L, D, B, I, TS = StringType(), LongType(), DoubleType(), BooleanType(), IntegerType(), TimestampType()


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# Bronze event log: the first nine columns of streaming_metrics.
EVENT_LOG = _struct(
    ("id", S, False),
    ("sequence", S, True),
    ("origin", S, True),
    ("timestamp", TS, False),
    ("message", S, True),
    ("level", S, False),
    ("event_type", S, False),
    ("maturity_level", S, True),
    ("details", S, False),
)

# Nullable copy used when reading a stream: the file source cannot enforce
# NOT NULL and the expectation operators must be able to see violations.
EVENT_LOG_READ = StructType([StructField(f.name, f.dataType, True) for f in EVENT_LOG.fields])

ORIGIN = _struct(
    ("workspace_id", S, True),
    ("job_id", S, True),
    ("flow_name", S, True),
    ("flow_id", S, True),
)

STATE_OPERATOR = _struct(
    ("operatorName", S, True),
    ("numRowsTotal", L, True),
    ("numRowsUpdated", L, True),
    ("memoryUsedBytes", L, True),
    ("numRowsDroppedByWatermark", L, True),
)

QUALITY = _struct(
    ("duplicate_rate", D, True),
    ("dropped_record_count", L, True),
    ("late_record_percentage", D, True),
    ("null_rate_by_column", MapType(S, D), True),
    ("schema_change_detected", B, True),
)

# StreamingQueryProgress as JSON (the subset the metrics read).  Scalars are
# read as strings where the producer may write non-numeric garbage; silver
# try_casts them so that malformed input yields nulls instead of failures.
PROGRESS = _struct(
    ("id", S, True),
    ("runId", S, True),
    ("name", S, True),
    ("timestamp", S, True),
    ("batchId", S, True),
    ("batchDuration", S, True),
    ("numInputRows", S, True),
    ("inputRowsPerSecond", S, True),
    ("processedRowsPerSecond", S, True),
    ("durationMs", MapType(S, L), True),
    ("eventTime", _struct(("avg", S, True), ("max", S, True), ("min", S, True), ("watermark", S, True)), True),
    ("stateOperators", ArrayType(STATE_OPERATOR), True),
    ("sources", ArrayType(_struct(("description", S, True), ("numInputRows", L, True))), True),
    ("sink", _struct(("description", S, True), ("numOutputRows", L, True)), True),
    ("observedMetrics", _struct(("quality", QUALITY, True)), True),
)

ERROR_DETAIL = _struct(
    ("batch_id", S, True),
    ("exception_type", S, True),
    ("message", S, True),
    ("termination_reason", S, True),
    ("stack_trace", S, True),
)

DETAILS = _struct(("stream_progress", PROGRESS, True), ("error", ERROR_DETAIL, True))

STREAMING_METRICS = StructType(
    EVENT_LOG.fields
    + _struct(
        ("environment", S, False),
        ("workspace_id", S, True),
        ("domain", S, True),
        ("owner", S, True),
        ("criticality", S, True),
        ("ingestion_ts", TS, False),
    ).fields
)

STREAM_ERRORS = _struct(
    ("query_id", S, True),
    ("query_name", S, True),
    ("batch_id", L, True),
    ("timestamp", TS, False),
    ("exception_type", S, True),
    ("exception_message", S, True),
    ("termination_reason", S, True),
    ("restart_count", I, True),
    ("stack_trace", S, True),
    ("environment", S, False),
    ("workspace_id", S, True),
    ("ingestion_ts", TS, False),
)

DATA_QUALITY_METRICS = _struct(
    ("query_id", S, False),
    ("query_name", S, True),
    ("batch_id", L, True),
    ("timestamp", TS, False),
    ("null_rate_by_column", MapType(S, D), True),
    ("duplicate_rate", D, True),
    ("dropped_record_count", L, True),
    ("schema_change_detected", B, True),
    ("late_record_percentage", D, True),
    ("environment", S, False),
    ("workspace_id", S, True),
    ("ingestion_ts", TS, False),
)

SLA_LATENCY_METRICS = _struct(
    ("query_id", S, False),
    ("query_name", S, True),
    ("batch_id", L, True),
    ("timestamp", TS, False),
    ("event_time_min", TS, True),
    ("event_time_max", TS, True),
    ("processing_time", TS, True),
    ("latency_ms", L, True),
    ("latency_p50", L, True),
    ("latency_p90", L, True),
    ("latency_p99", L, True),
    ("max_latency", L, True),
    ("sla_breach_flag", B, True),
    ("sla_threshold_ms", L, True),
    ("environment", S, False),
    ("workspace_id", S, True),
    ("ingestion_ts", TS, False),
)

INFRASTRUCTURE_METRICS = _struct(
    ("cluster_id", S, False),
    ("timestamp", TS, False),
    ("cpu_usage_percent", D, True),
    ("memory_usage_percent", D, True),
    ("executor_count", I, True),
    ("autoscaling_event", S, True),
    ("dbu_consumption", D, True),
    ("driver_node_type", S, True),
    ("worker_node_type", S, True),
    ("environment", S, False),
    ("workspace_id", S, True),
    ("ingestion_ts", TS, False),
)

SILVER_TABLES = {
    "streaming_metrics": STREAMING_METRICS,
    "stream_errors": STREAM_ERRORS,
    "data_quality_metrics": DATA_QUALITY_METRICS,
    "sla_latency_metrics": SLA_LATENCY_METRICS,
    "infrastructure_metrics": INFRASTRUCTURE_METRICS,
}

# Sensor workload (the sample streaming job).
SENSOR_SOURCE = _struct(
    ("sensor_id", S, False),
    ("temperature", D, True),
    ("humidity", D, True),
    ("pressure", D, True),
    ("event_time", S, False),
    ("region", S, True),
    ("facility", S, True),
)
SENSOR_BRONZE = _struct(
    ("sensor_id", S, False),
    ("temperature", D, True),
    ("humidity", D, True),
    ("pressure", D, True),
    ("event_time", TS, False),
    ("region", S, True),
    ("facility", S, True),
    ("ingestion_ts", TS, True),
)
SENSOR_GOLD = _struct(
    ("window_start", TS, False),
    ("window_end", TS, False),
    ("region", S, False),
    ("sensor_count", L, True),
    ("avg_temperature", D, True),
    ("max_temperature", D, True),
    ("min_temperature", D, True),
    ("avg_humidity", D, True),
    ("record_count", L, True),
)

# Alert rules, escalation and tags.
ALERT_RULE = _struct(
    ("name", S, False),
    ("query_name", S, False),
    ("schedule_interval_seconds", I, False),
    ("op", S, False),
    ("op_type", S, True),
    ("column", S, False),
    ("threshold", D, False),
    ("severity", S, False),
    ("escalation", S, True),
    ("rearm_seconds", I, False),
    ("description", S, True),
)
ESCALATION_SCHEMA = _struct(("severity", S, False), ("channel", S, False))
TAGS = _struct(("query_id", S, False), ("domain", S, True), ("owner", S, True), ("criticality", S, True))
