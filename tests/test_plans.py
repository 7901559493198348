"""Plan-shape checks: the properties the operators rely on at scale."""

from __future__ import annotations

import tempfile

import pytest
from sf_paths import SF0001

import __spark_entry__ as E
from vigil.plans.checks import REGISTRY, SQL_READS
from vigil.operators import alerts, gold
from vigil.plans.context import BASE, Context
from vigil.plans.datasets import materialize
from vigil.sources.event_log import append_event_log, read_event_log

# Checks that run streams or write tables when called (plans not inspected here).
SIDE_EFFECTS = {
    "sensor_ingest", "incremental_equals_batch", "sensor_window_agg", "foreach_batch_quality", "backpressure_stream",
    "listener_capture", "retention_filter", "compaction_preserves_rows", "materialize_datasets", "silver_flow_stream",
    "monitoring_tables", "streamed_table_lifecycle", "throughput_trends_stream", "latency_sla_stream", "gold_incremental_refresh", "data_quality_stream",
    "overview_by_delta", "backpressure_by_delta", "state_growth_by_delta", "infrastructure_datasets",
    "duration_spike_stream", "stream_status_changes", "late_fraction_stream", "schema_changes", "evolving_ingest",
    "latency_rollup_day", "latency_rollup_range", "history_duplicates", "clustered_layout",
} | set(SQL_READS)  # these write their ordered rows; the reads themselves are inspected below
PANDAS_ALLOWED = {"alert_rearm"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SIDE_EFFECTS))
def test_no_cross_join_no_row_udf(spark, name):
    p = plan(E.queries()[name](spark, SF0001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, (name, bad)
    if name not in PANDAS_ALLOWED:
        assert "FlatMapGroupsInPandas" not in p and "MapInPandas" not in p, name


@pytest.mark.parametrize("name", sorted(SQL_READS))
def test_dashboard_reads_scan_the_given_tables(spark, name):
    p = plan(SQL_READS[name](Context.of(spark, SF0001)))
    assert "FileScan parquet" in p and "testdata/sf0.001" in p, name
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


def test_top_k_per_stream_is_a_group_limit(spark):
    c = Context(spark, SF0001)
    p = plan(alerts.sustained_backpressure(c.prog, c.cfg, lookback_minutes=10080, min_count=0))
    assert "WindowGroupLimit" in p


def test_global_top_k_is_take_ordered(spark):
    c = Context(spark, SF0001, BASE.with_(lookback_days=30))
    assert "TakeOrderedAndProject" in plan(alerts.duration_spike(c.prog, c.cfg, lookback_minutes=43200))


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="vigil-plans-")
    c = Context(spark, SF0001)
    append_event_log(c.bronze, f"{root}/raw_events")
    paths = materialize(spark, read_event_log(spark, f"{root}/raw_events"), root, BASE, names={"stream_progress", "sla_latency_metrics"})
    return spark, paths


def test_stored_silver_prunes_days_and_pushes_time(stored):
    spark, paths = stored
    prog = spark.read.parquet(paths["stream_progress"])
    p = gold.throughput_trends(prog, BASE).__getattribute__("_jdf").queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in p and "event_date#" in p
    assert "PushedFilters: [" in p and "LessThanOrEqual(timestamp" in p


def test_stored_silver_alert_prunes_days(stored):
    spark, paths = stored
    sla = spark.read.parquet(paths["sla_latency_metrics"])
    p = plan(alerts.sla_breach(sla, BASE, lookback_minutes=10))
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "ReadSchema: struct<query_name:string,timestamp:timestamp,latency_ms:bigint" in p
    # columns the alert does not use are never read
    for unused in ("event_time_min", "workspace_id", "latency_p50", "processing_time"):
        assert unused not in p, unused


def test_overview_aggregates_before_joining(spark):
    c = Context(spark, SF0001, BASE.with_(lookback_days=None))
    p = plan(gold.stream_overview(c.prog, c.errors, c.sla, c.cfg))
    # each side of the two outer joins is a (partial + final) aggregate
    assert p.count("HashAggregate") >= 6


def test_backtest_prunes_days_and_never_joins(stored):
    from vigil.operators import evaluate

    spark, paths = stored
    sla = spark.read.parquet(paths["sla_latency_metrics"])
    p = plan(evaluate.backtest_counts(sla.filter("sla_breach_flag"), "alert_sla_breach", "query_name", 10, 300, "2024-01-01 00:00:00", "2024-01-31 00:00:00"))
    assert "PartitionFilters: [isnotnull(event_date" in p and "Generate explode" in p
    assert "Join" not in p


def test_incremental_refresh_reads_only_the_given_days(stored):
    import datetime as dt
    import os

    from vigil.plans.datasets import DATASETS, Inputs

    spark, paths = stored
    root = os.path.dirname(paths["stream_progress"])
    days = [dt.date(2024, 1, 20), dt.date(2024, 1, 21)]
    df = DATASETS["mv_throughput_trends"].build(Inputs(spark, None, root, days=days), BASE.with_(lookback_days=None))
    formatted = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    line = next(x for x in formatted.splitlines() if x.startswith("PartitionFilters"))
    assert "IN (2024-01-20,2024-01-21)" in line


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - SIDE_EFFECTS))
def test_every_check_scans_the_given_tables(spark, name):
    """Each registered query reads the given parquet tables (its work grows
    with them); none runs on made-up input alone."""
    p = plan(E.queries()[name](spark, SF0001))
    assert "FileScan parquet" in p and "testdata/sf0.001" in p, name
