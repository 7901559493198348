"""Infrastructure metrics (S7, S9): usage normalisation and autoscale events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.functions.core import as_of_col
from vigil.operators import frames


def usage_to_infrastructure(usage: DataFrame, cfg: MonitorConfig, lookback_days: int | None = None) -> DataFrame:
    """Billing usage rows -> infrastructure rows.

    ``usage`` carries ``usage_date`` (timestamp), ``usage_metadata.cluster_id``,
    ``usage_quantity`` and ``workspace_id``.  Rows without a cluster are
    dropped; gauges the usage feed does not carry are typed nulls."""
    days = cfg.lookback_days if lookback_days is None else lookback_days
    cond = F.col("usage_metadata.cluster_id").isNotNull()
    if days is not None:
        cond = cond & (F.col("usage_date") >= F.date_sub(F.to_date(as_of_col(cfg.as_of)), days))
    return usage.filter(cond).select(
        F.col("usage_metadata.cluster_id").alias("cluster_id"),
        F.col("usage_date").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("double").alias("cpu_usage_percent"),
        F.lit(None).cast("double").alias("memory_usage_percent"),
        F.lit(None).cast("int").alias("executor_count"),
        F.lit(None).cast("string").alias("autoscaling_event"),
        F.round(F.col("usage_quantity").cast("decimal(18,6)"), 2).cast("double").alias("dbu_consumption"),
        F.lit(None).cast("string").alias("driver_node_type"),
        F.lit(None).cast("string").alias("worker_node_type"),
        F.lit(cfg.environment).alias("environment"),
        F.col("workspace_id").cast("string").alias("workspace_id"),
        F.current_timestamp().alias("ingestion_ts"),
    )


def autoscale_events(samples: DataFrame, cfg: MonitorConfig, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """SCALE_UP / SCALE_DOWN when the executor count rises / falls
    against the cluster's previous sample; null for the first sample and
    for no change.

    A cluster's samples are split into time chunks and blocks, so a single
    busy cluster is not evaluated by one task."""
    chunk = F.floor(F.unix_seconds(F.col("timestamp")) / F.lit(cfg.time_chunk_seconds))
    lagged = frames.rows_frame(
        samples,
        ["cluster_id"],
        list(order),
        1,
        lambda w: {"_prev_exec": F.lag("executor_count").over(w)},
        cfg.frame_block_rows,
        chunk,
    )
    ev = (
        F.when(F.col("_prev_exec").isNull(), F.lit(None).cast("string"))
        .when(F.col("executor_count") > F.col("_prev_exec"), "SCALE_UP")
        .when(F.col("executor_count") < F.col("_prev_exec"), "SCALE_DOWN")
    )
    return lagged.withColumn("autoscaling_event", ev).drop("_prev_exec")
