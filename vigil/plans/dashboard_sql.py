"""The dashboard and alert reads as parameterised Spark SQL.

Metrics are defined once, in ``operators/gold.py`` and ``operators/alerts.py``.
A read is one ``spark.sql(text, args=...)`` over the metric's DataFrame that
binds the entity to show (null: all) and gives the display order; the view it
reads through is the call's own, so reads of one session do not meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.config import MonitorConfig
from vigil.operators import alerts, gold

Silver = dict[str, DataFrame]

#: dataset -> (definition over the silver tables, entity column, display order)
READS: dict[str, tuple[Callable[..., DataFrame], str, str]] = {
    "stream_overview": (lambda s, c: gold.stream_overview(s["stream_progress"], s["stream_errors"], s["sla_latency_metrics"], c), "query_name", "query_name"),
    "throughput_trends": (lambda s, c: gold.throughput_trends(s["stream_progress"], c), "query_name", "query_name, time_bucket"),
    "latency_sla": (lambda s, c: gold.latency_sla(s["sla_latency_metrics"], c), "query_name", "query_name, time_bucket"),
    "backpressure": (lambda s, c: gold.backpressure(s["stream_progress"], c), "query_name", "query_name, batch_id DESC"),
    "state_store_health": (lambda s, c: gold.state_store_health(s["stream_progress"], c), "query_name", "query_name, batch_id"),
    "data_quality_hourly": (lambda s, c: gold.data_quality_hourly(s["data_quality_metrics"], c), "query_name", "query_name, time_bucket"),
    "infra_cost_hourly": (lambda s, c: gold.infra_cost_hourly(s["infrastructure_metrics"], c), "cluster_id", "cluster_id, time_bucket"),
    "alert_sla_breach": (lambda s, c, **k: alerts.sla_breach(s["sla_latency_metrics"], c, **k), "query_name", "query_name"),
    "alert_sustained_backpressure": (lambda s, c, **k: alerts.sustained_backpressure(s["stream_progress"], c, **k), "query_name", "query_name"),
    "alert_batch_duration_spike": (lambda s, c, **k: alerts.duration_spike(s["stream_progress"], c, **k), "query_name", "spike_factor DESC, query_name, batch_id"),
    "alert_stream_terminated": (lambda s, c, **k: alerts.stream_terminated(s["stream_errors"], c, **k), "query_name", "terminated_at DESC, query_id, exception_message"),
    "alert_state_memory_growth": (lambda s, c, **k: alerts.state_growth(s["stream_progress"], c, **k), "query_name", "query_name"),
}


def sql_of(dataset: str) -> str:
    _, entity, order = READS[dataset]
    return f"SELECT * FROM {{metric}} WHERE :entity IS NULL OR {entity} = :entity ORDER BY {order}"


def run(spark: SparkSession, dataset: str, silver: Silver, cfg: MonitorConfig, entity: str | None = None, **params) -> DataFrame:
    """One read, in display order; ``params`` are those of an alert's
    definition (lookback, thresholds)."""
    return spark.sql(sql_of(dataset), args={"entity": entity}, metric=READS[dataset][0](silver, cfg, **params))
