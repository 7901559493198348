"""Silver: event log -> typed metric tables.

The progress document is parsed once, with ``from_json`` against a fixed
schema, into typed columns; gold operators never touch JSON text.  Scalars
are read as text and ``try_cast`` so that malformed documents give nulls
(and raise expectation counts) instead of failing the stream.  Every
function here is stateless (filter + projection), so it runs unchanged on a
batch DataFrame, a streaming DataFrame and inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import config as C
from vigil import schemas
from vigil.config import MonitorConfig
from vigil.functions.core import fold_sum, iso_timestamp, ms_between, null_safe_gt, sanitize_name, seconds_between

PROGRESS_EVENT = "stream_progress"
ERROR_LEVELS = ("ERROR", "WARN")


def _env(cfg: MonitorConfig) -> Column:
    return F.lit(cfg.environment)


def _workspace(cfg: MonitorConfig) -> Column:
    ws = F.get_json_object(F.col("origin"), "$.workspace_id")
    return ws if cfg.workspace_id is None else F.coalesce(ws, F.lit(cfg.workspace_id))


def _tcast(c: Column, t: str) -> Column:
    """Cast that yields NULL for text that does not parse (ANSI-safe)."""
    return c.try_cast(t)


def progress_struct(details: str | Column = "details") -> Column:
    d = F.col(details) if isinstance(details, str) else details
    return F.from_json(d, schemas.DETAILS)["stream_progress"]


def streaming_metrics(bronze: DataFrame, cfg: MonitorConfig, tags: DataFrame | None = None) -> DataFrame:
    """P1 + P7: progress events in event-log form plus environment,
    workspace and business tags (criticality defaults to ``medium``).

    ``tags`` is a dimension table (one row per query id); it is joined on the
    query id carried in ``origin.flow_id``; Spark picks the join by the size
    it measures.
    """
    df = bronze.filter(F.col("event_type") == PROGRESS_EVENT).select(
        *[F.col(c) for c in (f.name for f in schemas.EVENT_LOG.fields)],
        _env(cfg).alias("environment"),
        _workspace(cfg).alias("workspace_id"),
        F.get_json_object(F.col("origin"), "$.flow_id").alias("_qid"),
    )
    if tags is None:
        df = df.select("*", F.lit(None).cast("string").alias("_domain"), F.lit(None).cast("string").alias("_owner"), F.lit(None).cast("string").alias("_crit"))
    else:
        t = tags.select(F.col("query_id").alias("_tqid"), F.col("domain").alias("_domain"), F.col("owner").alias("_owner"), F.col("criticality").alias("_crit"))
        df = df.join(t, df["_qid"] == t["_tqid"], "left").drop("_tqid")
    return df.select(
        *[f.name for f in schemas.EVENT_LOG.fields],
        "environment",
        "workspace_id",
        F.coalesce(F.col("_domain"), F.lit("")).alias("domain"),
        F.coalesce(F.col("_owner"), F.lit("")).alias("owner"),
        F.coalesce(F.col("_crit"), F.lit(C.DEFAULT_CRITICALITY)).alias("criticality"),
        F.current_timestamp().alias("ingestion_ts"),
    )


def progress(metrics: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """Typed view of the progress rows: the single parse every gold metric
    reads.  Accepts bronze rows or ``streaming_metrics`` rows."""
    if "environment" not in metrics.columns:
        metrics = metrics.filter(F.col("event_type") == PROGRESS_EVENT).withColumn("environment", _env(cfg))
    else:
        metrics = metrics.filter(F.col("event_type") == PROGRESS_EVENT)
    ws = "workspace_id" if "workspace_id" in metrics.columns else None
    p = metrics.select(
        F.col("id").alias("event_id"),
        F.col("timestamp"),
        F.col("environment"),
        (F.col(ws) if ws else _workspace(cfg)).alias("workspace_id"),
        progress_struct().alias("p"),
    )
    et = F.col("p.eventTime")
    ops = F.col("p.stateOperators")
    q = F.col("p.observedMetrics.quality")
    return p.select(
        "event_id",
        F.col("p.id").alias("query_id"),
        sanitize_name(F.col("p.name")).alias("query_name"),
        F.col("p.name").alias("raw_query_name"),
        F.col("p.runId").alias("run_id"),
        _tcast(F.col("p.batchId"), "bigint").alias("batch_id"),
        "timestamp",
        iso_timestamp(F.col("p.timestamp")).alias("trigger_ts"),
        _tcast(F.col("p.batchDuration"), "bigint").alias("batch_duration_ms"),
        F.coalesce(_tcast(F.col("p.numInputRows"), "bigint"), F.lit(0).cast("bigint")).alias("num_input_rows"),
        F.coalesce(_tcast(F.col("p.inputRowsPerSecond"), "double"), F.lit(0.0)).alias("input_rows_per_second"),
        F.coalesce(_tcast(F.col("p.processedRowsPerSecond"), "double"), F.lit(0.0)).alias("processed_rows_per_second"),
        iso_timestamp(et["min"]).alias("event_time_min"),
        iso_timestamp(et["max"]).alias("event_time_max"),
        iso_timestamp(et["watermark"]).alias("watermark"),
        fold_sum(ops, "memoryUsedBytes").alias("state_memory_bytes"),
        fold_sum(ops, "numRowsTotal").alias("state_rows_total"),
        fold_sum(ops, "numRowsDroppedByWatermark").alias("rows_dropped_by_watermark"),
        q["duplicate_rate"].alias("duplicate_rate"),
        q["dropped_record_count"].alias("dropped_record_count"),
        q["late_record_percentage"].alias("late_record_percentage"),
        q["null_rate_by_column"].alias("null_rate_by_column"),
        q["schema_change_detected"].alias("schema_change_detected"),
        q.isNotNull().alias("has_quality"),
        "environment",
        "workspace_id",
    )


def stream_errors(bronze: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """ERROR / WARN events with the error fields of ``details``."""
    e = F.from_json(F.col("details"), schemas.DETAILS)["error"]
    return bronze.filter(F.col("level").isin(*ERROR_LEVELS)).select(
        F.get_json_object(F.col("origin"), "$.flow_id").alias("query_id"),
        F.get_json_object(F.col("origin"), "$.flow_name").alias("query_name"),
        _tcast(e["batch_id"], "bigint").alias("batch_id"),
        F.col("timestamp"),
        e["exception_type"].alias("exception_type"),
        e["message"].alias("exception_message"),
        e["termination_reason"].alias("termination_reason"),
        F.lit(None).cast("int").alias("restart_count"),
        e["stack_trace"].alias("stack_trace"),
        _env(cfg).alias("environment"),
        _workspace(cfg).alias("workspace_id"),
        F.current_timestamp().alias("ingestion_ts"),
    )


def latency_ms(processing: Column, event_max: Column, cfg: MonitorConfig) -> Column:
    """Processing time minus newest event time.  ``ms`` keeps milliseconds;
    ``seconds`` reproduces whole seconds times 1000."""
    if cfg.latency_precision == "seconds":
        return (seconds_between(processing, event_max) * 1000).cast("bigint")
    return ms_between(processing, event_max).cast("bigint")


def sla_latency_metrics(prog: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """Per-batch latency and SLA breach flag (null latency -> no breach).

    Latency is measured from the newest event time of the batch to the
    progress row's timestamp.  The four percentile columns repeat the batch
    latency (one value per batch); real percentiles are computed in gold."""
    return _sla(prog, latency_ms(F.col("timestamp"), F.col("event_time_max"), cfg), cfg)


def _sla(prog: DataFrame, lat: Column, cfg: MonitorConfig) -> DataFrame:
    return prog.select(
        "query_id",
        "query_name",
        "batch_id",
        "timestamp",
        "event_time_min",
        "event_time_max",
        F.col("timestamp").alias("processing_time"),
        lat.alias("latency_ms"),
        lat.alias("latency_p50"),
        lat.alias("latency_p90"),
        lat.alias("latency_p99"),
        lat.alias("max_latency"),
        null_safe_gt(lat, F.lit(cfg.sla_ms)).alias("sla_breach_flag"),
        F.lit(cfg.sla_ms).cast("bigint").alias("sla_threshold_ms"),
        "environment",
        "workspace_id",
        F.current_timestamp().alias("ingestion_ts"),
    )


def data_quality_metrics(prog: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """Quality figures reported through ``observedMetrics.quality``.

    Batches that report no ``quality`` object (including ``{}``) give no
    row, so empty reports do not inflate batch counts."""
    return prog.filter(F.col("has_quality")).select(
        "query_id",
        "query_name",
        "batch_id",
        "timestamp",
        "null_rate_by_column",
        "duplicate_rate",
        "dropped_record_count",
        F.coalesce("schema_change_detected", F.lit(False)).alias("schema_change_detected"),
        "late_record_percentage",
        "environment",
        "workspace_id",
        F.current_timestamp().alias("ingestion_ts"),
    )


def event_log_record(prog_rows: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """P5: build event-log records from typed progress rows (the capture
    side): deterministic id, JSON sequence / origin, message, METRICS level.

    ``prog_rows`` needs query_id, query_name, batch_id, timestamp, details.
    """
    name = sanitize_name(F.col("query_name"))
    return prog_rows.select(
        F.sha2(F.concat_ws("|", F.col("run_id"), F.col("batch_id").cast("string")), 256).alias("id"),
        F.to_json(F.struct(F.col("batch_id").alias("batch_id"))).alias("sequence"),
        F.to_json(
            F.struct(
                F.lit(cfg.workspace_id).cast("string").alias("workspace_id"),
                F.lit(None).cast("string").alias("job_id"),
                name.alias("flow_name"),
                F.col("query_id").alias("flow_id"),
            )
        ).alias("origin"),
        F.col("timestamp"),
        F.format_string(C.PROGRESS_MESSAGE, name, F.col("batch_id")).alias("message"),
        F.lit("METRICS").alias("level"),
        F.lit(PROGRESS_EVENT).alias("event_type"),
        F.lit("STABLE").alias("maturity_level"),
        F.col("details"),
    )


#: Fixed value: reason of an error that did not end the stream.
RETRYABLE = "RETRYABLE"


def dedupe_events(bronze: DataFrame) -> DataFrame:
    """Replay idempotence: one row per event id (ids are deterministic)."""
    return bronze.dropDuplicates(["id"])


def with_restart_counts(errors: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """``restart_count`` is the number of terminations of the query up to
    and with each row (1 at the first).  Rows of a retryable error are no
    terminations; they show the count so far.

    The running count is split by day, so a stream with a very long error
    history is numbered by many tasks (see frames.dense_index)."""
    from vigil.operators import frames

    chunk = F.floor(F.unix_seconds(F.col("timestamp")) / F.lit(cfg.time_chunk_seconds))
    ended = F.when(F.col("termination_reason").eqNullSafe(RETRYABLE), 0).otherwise(1)
    counted = frames.running_sum(errors.withColumn("_ended", ended), ["query_id"], ["timestamp", "exception_message"], "_ended", "restart_count", chunk)
    return counted.withColumn("restart_count", F.col("restart_count").cast("int")).select(*[f.name for f in schemas.STREAM_ERRORS.fields])


def observed_metrics(bronze: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """P18 / U1 on streams: every named observation of every batch (from
    ``DataFrame.observe``: expectation counts, quality figures), one row per
    (stream, batch, observation, metric) with the value as a double.

    The observation names and metrics are data, not schema: the document is
    read as map<string, map<string, string>> and exploded, so any set of
    rules lands in the same table.  Values that are no numbers (the null-rate
    map, the schema flag) are left to ``data_quality_metrics``."""
    obs = F.from_json(F.get_json_object(F.col("details"), "$.stream_progress.observedMetrics"), "map<string,map<string,string>>")
    p = bronze.filter(F.col("event_type") == PROGRESS_EVENT).select(
        F.get_json_object(F.col("details"), "$.stream_progress.id").alias("query_id"),
        sanitize_name(F.get_json_object(F.col("details"), "$.stream_progress.name")).alias("query_name"),
        _tcast(F.get_json_object(F.col("details"), "$.stream_progress.batchId"), "bigint").alias("batch_id"),
        F.col("timestamp"),
        F.explode(obs).alias("observation", "_m"),
    )
    return p.select(
        "query_id", "query_name", "batch_id", "timestamp", "observation",
        F.explode("_m").alias("metric", "_v"),
    ).select("query_id", "query_name", "batch_id", "timestamp", "observation", "metric", _tcast(F.col("_v"), "double").alias("value"), _env(cfg).alias("environment")).where("value is not null")
