"""Dataset registry and materialisation (K5).

Every silver and gold dataset is declared once with ``@dataset(name,
layer, comment)``.  ``materialize`` writes silver from bronze (partitioned
by ``event_date``, so later reads prune days) and then gold from the
*stored* silver tables, so gold never re-derives silver.  Writes are
``overwrite`` of whole datasets; a re-run after a failure rewrites the same
result.  The table comment and layer are kept as a small metadata file
next to each dataset.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import gold, infra, silver
from vigil.plans import delta


@dataclass(frozen=True)
class Dataset:
    name: str
    layer: str
    comment: str
    build: Callable[["Inputs", MonitorConfig], DataFrame]
    partitioned: bool
    date_from: str = "timestamp"      # column whose date is the partition
    incremental: bool = False         # a day's rows depend on that day's input only


DATASETS: dict[str, Dataset] = {}


def dataset(name: str, layer: str, comment: str, partitioned: bool | None = None, date_from: str = "timestamp", incremental: bool = False):
    def deco(fn):
        part = layer == "silver" if partitioned is None else partitioned
        DATASETS[name] = Dataset(name, layer, comment, fn, part, date_from, incremental)
        return fn

    return deco


class Inputs:
    """Resolves dataset names: bronze is given; silver names resolve to the
    stored tables under ``root``, optionally restricted to some days (a
    partition filter: other days are not listed).  ``samples``: cluster
    gauges, without which the infrastructure datasets are left out."""

    def __init__(self, spark: SparkSession, bronze: DataFrame | None, root: str, days: list | None = None, samples: DataFrame | None = None):
        self.spark, self.bronze, self.root, self.days, self.samples = spark, bronze, root, days, samples

    def on(self, days: list) -> "Inputs":
        return Inputs(self.spark, self.bronze, self.root, days, self.samples)

    def has(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def stored(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(os.path.join(self.root, name))
        if self.days is not None:
            df = df.filter(F.col("event_date").isin(list(self.days)))
        return df


# ----------------------------------------------------------------- silver ---

@dataset("streaming_metrics", "silver", "Per-micro-batch streaming metrics in event-log format")
def _streaming_metrics(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return silver.streaming_metrics(i.bronze, cfg)


@dataset("stream_progress", "silver", "Typed progress fields, parsed once from the event log")
def _stream_progress(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return silver.progress(i.bronze, cfg)


@dataset("stream_errors", "silver", "Stream error and termination events with restart counts")
def _stream_errors(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return silver.with_restart_counts(silver.stream_errors(i.bronze, cfg), cfg)


@dataset("sla_latency_metrics", "silver", "Per-batch latency and SLA breach flag")
def _sla(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return silver.sla_latency_metrics(i.stored("stream_progress"), cfg)


@dataset("data_quality_metrics", "silver", "Per-batch quality figures from observed metrics")
def _dq(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return silver.data_quality_metrics(i.stored("stream_progress"), cfg)


@dataset("infrastructure_metrics", "silver", "Cluster gauges with autoscale events")
def _infra(i: Inputs, cfg: MonitorConfig) -> DataFrame | None:
    return None if i.samples is None else infra.autoscale_events(i.samples, cfg, order=("timestamp", "sample_id"))


# ------------------------------------------------------------------- gold ---

@dataset("mv_stream_overview", "gold", "Stream overview: status, uptime, last batch, SLA breaches")
def _overview(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.stream_overview(i.stored("stream_progress"), i.stored("stream_errors"), i.stored("sla_latency_metrics"), cfg)


@dataset("mv_throughput_trends", "gold", partitioned=True, date_from="time_bucket", incremental=True, comment="Throughput trends per minute")
def _throughput(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.throughput_trends(i.stored("stream_progress"), cfg)


@dataset("mv_latency_sla", "gold", partitioned=True, date_from="time_bucket", incremental=True, comment="Latency percentiles and breach rate per 5 minutes")
def _latency(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.latency_sla(i.stored("sla_latency_metrics"), cfg)


@dataset("mv_backpressure", "gold", partitioned=True, comment="Backpressure ratio and sustained status per batch")
def _backpressure(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.backpressure(i.stored("stream_progress"), cfg)


@dataset("mv_state_store_health", "gold", partitioned=True, comment="State memory and growth per batch")
def _state(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.state_store_health(i.stored("stream_progress"), cfg)


@dataset("mv_data_quality", "gold", partitioned=True, date_from="time_bucket", incremental=True, comment="Hourly data quality")
def _quality(i: Inputs, cfg: MonitorConfig) -> DataFrame:
    return gold.data_quality_hourly(i.stored("data_quality_metrics"), cfg)


@dataset("mv_infrastructure_cost", "gold", partitioned=True, date_from="time_bucket", incremental=True, comment="Hourly cluster load and cost")
def _infra_cost(i: Inputs, cfg: MonitorConfig) -> DataFrame | None:
    return gold.infra_cost_hourly(i.stored("infrastructure_metrics"), cfg) if i.has("infrastructure_metrics") else None


def materialize(
    spark: SparkSession,
    bronze: DataFrame,
    root: str,
    cfg: MonitorConfig,
    layers: tuple[str, ...] = ("silver", "gold"),
    names: set[str] | None = None,
    samples: DataFrame | None = None,
) -> dict[str, str]:
    """Write the datasets of ``layers`` (or only ``names``) in declaration
    order (silver before gold); returns name -> path.  A whole gold layer over
    all history also writes the state that ``refresh`` goes on from."""
    inputs = Inputs(spark, bronze, root, samples=samples)
    out = {}
    for d in DATASETS.values():
        if d.layer not in layers or (names is not None and d.name not in names):
            continue
        path = os.path.join(root, d.name)
        df = d.build(inputs, cfg)
        if df is None:
            continue
        w = df.withColumn("event_date", F.to_date(d.date_from)).write.mode("overwrite").partitionBy("event_date") if d.partitioned else df.write.mode("overwrite")
        w.parquet(path)
        _write_meta(spark, path, {"name": d.name, "layer": d.layer, "comment": d.comment})
        out[d.name] = path
    if "gold" in layers and names is None and cfg.lookback_days is None:
        delta.write_state(inputs, cfg)
    return out


def refresh(spark: SparkSession, root: str, cfg: MonitorConfig, days: list) -> dict[str, str]:
    """Incremental refresh of the day-partitioned gold datasets: recompute
    only ``days`` (the days new silver rows fell on) from those days of the
    stored silver, and replace just those partitions (dynamic partition
    overwrite).  Exact for bucketed metrics, whose buckets never cross
    midnight.  The overview and the row frames, which look across days, are
    refreshed from stored partials and tails (``delta``); with a lookback in
    ``cfg`` their rows leave it as the clock moves, so they are rebuilt from
    the days of the lookback."""
    inputs = Inputs(spark, None, root, days=days)
    full = Inputs(spark, None, root)
    out = {}
    for d in DATASETS.values():
        if d.layer != "gold":
            continue
        path = os.path.join(root, d.name)
        if not d.incremental and cfg.lookback_days is None:
            continue
        df = d.build(inputs if d.incremental else full, cfg)
        if df is None:
            continue
        if d.incremental:
            df = df.withColumn("event_date", F.to_date(d.date_from))
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
        elif d.partitioned:
            df.withColumn("event_date", F.to_date(d.date_from)).write.mode("overwrite").partitionBy("event_date").parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        out[d.name] = path
    if cfg.lookback_days is None:
        if not full.has("_tails"):
            delta.write_state(full, cfg)
        out.update(delta.refresh(full, cfg, days))
    return out


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(path + "_meta")
