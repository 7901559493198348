"""Streaming flows: bronze -> silver with checkpoints, per-batch quality via
``foreachBatch`` (U1), streaming backpressure (T8) and the rate demo (S5).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import maintain, quality, silver
from vigil.sources.event_log import read_event_log_stream
from vigil.streaming.ordered import duration_spike_stream, stream_status_changes
from vigil.streaming.state import backpressure_stream


SILVER_FLOWS = ("streaming_metrics", "stream_progress", "stream_errors", "sla_latency_metrics", "data_quality_metrics")


def run_silver_flow(
    spark: SparkSession,
    bronze_dir: str,
    out_dir: str,
    checkpoint: str,
    table: str,
    cfg: MonitorConfig,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    dedupe_within: str | None = None,
    to_table: str | None = None,
):
    """One stateless silver flow (streaming_metrics / stream_progress /
    stream_errors / sla_latency_metrics / data_quality_metrics) from the
    bronze stream, with its own checkpoint.  Each micro-batch goes into
    partitions of its own below its days (``maintain.write_batch``: idempotent,
    no sink log), which retention and compaction may rewrite.  Default: drain what is there
    (``availableNow``) and stop; with ``processing_time`` (T6) the flow runs
    continuously and the running query is returned.

    ``dedupe_within`` (e.g. ``"1 hour"``): replayed bronze rows (same
    deterministic event id) are dropped with ``dropDuplicatesWithinWatermark``;
    the de-duplication state only holds ids newer than the watermark, and
    rows older than it are treated as late by the stream.

    ``to_table``: append into a catalog table (e.g. one created by
    ``maintain.create_monitoring_tables``) instead of a folder."""
    bronze = read_event_log_stream(spark, bronze_dir, max_files_per_trigger)
    if dedupe_within:
        bronze = bronze.withWatermark("timestamp", dedupe_within).dropDuplicatesWithinWatermark(["id"])
    if table == "streaming_metrics":
        out = silver.streaming_metrics(bronze, cfg)
    elif table == "stream_progress":
        out = silver.progress(bronze, cfg)
    elif table == "stream_errors":
        out = silver.stream_errors(bronze, cfg)
    elif table == "sla_latency_metrics":
        out = silver.sla_latency_metrics(silver.progress(bronze, cfg), cfg)
    elif table == "data_quality_metrics":
        out = silver.data_quality_metrics(silver.progress(bronze, cfg), cfg)
    else:
        raise ValueError(table)
    source = hashlib.sha1(checkpoint.encode()).hexdigest()[:10]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = maintain.stream_batch(source, batch_id)
        if to_table:
            maintain.insert_batch(batch, to_table, name)
        else:
            maintain.write_batch(batch, out_dir, name)

    q = out.withColumn("event_date", F.to_date("timestamp")).writeStream.foreachBatch(write).queryName(f"silver_{table}").option("checkpointLocation", checkpoint)
    q = q.trigger(processingTime=processing_time) if processing_time else q.trigger(availableNow=True)
    q = q.start()
    if processing_time:
        return q
    q.awaitTermination()
    return q


def run_silver_flows(spark: SparkSession, bronze_dir: str, root: str, cfg: MonitorConfig, tables=SILVER_FLOWS) -> dict[str, str]:
    """All silver flows, one checkpoint each (a failure of one flow does not
    replay the others).  Returns table -> output folder."""
    out = {}
    for t in tables:
        run_silver_flow(spark, bronze_dir, f"{root}/{t}", f"{root}/_checkpoints/{t}", t, cfg)
        out[t] = f"{root}/{t}"
    return out


def batch_quality(batch: DataFrame, batch_id: int) -> DataFrame:
    """Quality of one micro-batch, measured on its rows: per event day,
    record count, distinct sensors, duplicate rate, null rate of the
    readings."""
    day = F.to_date("event_time")
    return batch.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("sensor_id").alias("distinct_sensors"),
        F.avg(F.col("temperature").isNull().cast("double")).alias("temperature_null_rate"),
    ).select(
        "day",
        "record_count",
        "distinct_sensors",
        ((F.col("record_count") - F.col("distinct_sensors")) / F.col("record_count").cast("double")).alias("duplicate_rate"),
        "temperature_null_rate",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def run_quality_stream(source: DataFrame, out_dir: str, checkpoint: str):
    """Run ``batch_quality`` on every micro-batch.  Each batch overwrites
    its own ``batch_id=N`` folder, so a replayed batch (after a failure) is
    written again, not twice."""

    def sink(df: DataFrame, batch_id: int) -> None:
        batch_quality(df, batch_id).drop("batch_id").write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_lateness_stream(source: DataFrame, out_dir: str, marks_dir: str, checkpoint: str, stream: str, batch: str, event_time: str, delay_seconds: int):
    """T7 live: late rows counted per batch as they arrive, before any
    watermark drops them.

    The mark in force (newest event time of a stream's earlier batches) is
    carried from one micro-batch to the next as a table of one row per stream;
    micro-batch N reads the marks of N - 1 and overwrites its own results and
    marks, so a repeated micro-batch gives the same.  Rows are aggregated in
    their tasks: a busy stream is not sent to one.  A batch must not be spread
    over several micro-batches."""

    def count(df: DataFrame, n: int) -> None:
        spark = df.sparkSession
        carried = spark.read.parquet(f"{marks_dir}/micro_batch={n - 1}") if n > 0 else None
        late = quality.late_fraction(df, stream, batch, event_time, delay_seconds, carried=carried)
        late.write.mode("overwrite").parquet(f"{out_dir}/micro_batch={n}")
        quality.event_time_marks(df, stream, event_time, carried).write.mode("overwrite").parquet(f"{marks_dir}/micro_batch={n}")

    q = source.writeStream.foreachBatch(count).queryName("lateness").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_backpressure_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig, max_files_per_trigger: int = 1):
    """Sustained backpressure on the live progress stream (per-stream
    state), appended as rows arrive."""
    prog = silver.progress(read_event_log_stream(spark, bronze_dir, max_files_per_trigger), cfg)
    q = (
        backpressure_stream(prog)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName("backpressure_stream")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_dir)
    )
    q.awaitTermination()
    return q


def _progress_stream(spark: SparkSession, bronze_dir: str, cfg: MonitorConfig) -> DataFrame:
    prog = silver.progress(read_event_log_stream(spark, bronze_dir), cfg)
    return prog.filter(F.col("environment") == F.lit(cfg.environment))


def run_spike_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig, delay: str = "10 minutes"):
    """Drain the progress stream into the live spike detector."""
    return _run_append(duration_spike_stream(_progress_stream(spark, bronze_dir, cfg), delay), "duration_spike_stream", out_dir, checkpoint)


def run_status_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig, delay: str = "10 minutes"):
    """A4: drain the progress stream into the live status changes."""
    return _run_append(stream_status_changes(_progress_stream(spark, bronze_dir, cfg), delay, cfg), "stream_status_changes", out_dir, checkpoint)


def rate_demo(spark: SparkSession, out_name: str, rows_per_second: int = 100, seconds: float = 3.0):
    """S5 + K3: rate source into a memory sink on the default trigger,
    stopped after ``seconds`` (a live demo to attach the listener to)."""
    import time

    q = (
        spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
        .select("timestamp", "value", (F.col("value") % 10).alias("bucket"))
        .writeStream.format("memory").queryName(out_name).outputMode("append").start()
    )
    time.sleep(seconds)
    q.processAllAvailable()
    q.stop()
    return q


def bucketed_stream(metric, df: DataFrame, cfg: MonitorConfig, watermark: str = "10 minutes") -> DataFrame:
    """The streaming form of a time-bucketed gold metric is the gold
    function itself applied to a watermarked stream: state is kept per
    (key, bucket) and each bucket is emitted once the watermark closes it
    (append mode)."""
    return metric(df.withWatermark("timestamp", watermark), cfg.with_(lookback_days=None, as_of=None))


def throughput_trends_stream(prog: DataFrame, cfg: MonitorConfig = MonitorConfig(), watermark: str = "10 minutes") -> DataFrame:
    """A5 on a stream (same definition as ``gold.throughput_trends``)."""
    from vigil.operators import gold

    return bucketed_stream(gold.throughput_trends, prog, cfg, watermark)


def latency_sla_stream(sla: DataFrame, cfg: MonitorConfig = MonitorConfig(), watermark: str = "10 minutes") -> DataFrame:
    """A6 on a stream: the quantile sketches live in the aggregation state."""
    from vigil.operators import gold

    return bucketed_stream(gold.latency_sla, sla, cfg, watermark)


def data_quality_stream(dq: DataFrame, cfg: MonitorConfig = MonitorConfig(), watermark: str = "10 minutes") -> DataFrame:
    """A7 on a stream: hourly quality buckets emitted once closed."""
    from vigil.operators import gold

    return bucketed_stream(gold.data_quality_hourly, dq, cfg, watermark)


def _run_append(df: DataFrame, name: str, out_dir: str, checkpoint: str):
    q = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out_dir)
    )
    q.awaitTermination()
    return q


def run_throughput_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig):
    """Drain the progress stream into the streaming throughput trends."""
    prog = silver.progress(read_event_log_stream(spark, bronze_dir), cfg)
    return _run_append(throughput_trends_stream(prog, cfg), "throughput_trends_stream", out_dir, checkpoint)


def run_quality_hourly_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig):
    """Drain the progress stream into the streaming hourly data quality."""
    dq = silver.data_quality_metrics(silver.progress(read_event_log_stream(spark, bronze_dir), cfg), cfg)
    return _run_append(data_quality_stream(dq, cfg), "data_quality_stream", out_dir, checkpoint)


def run_latency_stream(spark: SparkSession, bronze_dir: str, out_dir: str, checkpoint: str, cfg: MonitorConfig):
    """Drain the progress stream into the streaming latency & SLA buckets."""
    sla = silver.sla_latency_metrics(silver.progress(read_event_log_stream(spark, bronze_dir), cfg), cfg)
    return _run_append(latency_sla_stream(sla, cfg), "latency_sla_stream", out_dir, checkpoint)
