"""Registered checks: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Each reads the given tables and runs the real
operator chain (bronze JSON -> silver parse -> gold / alerts); outputs keep
only deterministic columns and timestamps in UTC wall-clock form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.functions.core import severity_tier, to_ntz
from vigil.operators import alerts, gold, silver
from vigil.plans.context import AS_OF_END, AS_OF_OVERVIEW, BASE, Context

Check = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Check] = {}


def check(name: str):
    def deco(fn):
        REGISTRY[name] = lambda spark, sf_dir: to_ntz(fn(Context.of(spark, sf_dir)))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn

    return deco


# ---------------------------------------------------------------- silver ----

@check("bronze_events")
def bronze_events(c: Context) -> DataFrame:
    """Bronze event log (typed projection of the JSON envelope)."""
    return c.bronze.select(
        "id",
        "timestamp",
        "level",
        "event_type",
        "maturity_level",
        "message",
        F.get_json_object("origin", "$.flow_id").alias("query_id"),
        F.get_json_object("sequence", "$.batch_id").cast("bigint").alias("batch_id"),
    )


@check("silver_streaming_metrics")
def silver_streaming_metrics(c: Context) -> DataFrame:
    """Progress rows in event-log form with environment and tags."""
    return c.metrics.select(
        "id", "timestamp", "message", "level", "event_type", "maturity_level", "environment", "workspace_id", "domain", "owner", "criticality"
    )


@check("silver_stream_errors")
def silver_stream_errors(c: Context) -> DataFrame:
    """P2 + P19 (drop form): ERROR / WARN rows with the error fields."""
    return c.errors_raw.drop("ingestion_ts")


@check("silver_sla_latency")
def silver_sla_latency(c: Context) -> DataFrame:
    """Per-batch latency and breach flag."""
    return c.sla.drop("ingestion_ts")


@check("silver_data_quality")
def silver_data_quality(c: Context) -> DataFrame:
    """Quality figures from observedMetrics.quality."""
    return c.dq.withColumn("value_null_rate", F.col("null_rate_by_column")["value"]).drop("ingestion_ts", "null_rate_by_column")


@check("silver_progress")
def silver_progress(c: Context) -> DataFrame:
    """The typed progress view every gold metric reads."""
    return c.prog.select(
        "query_id", "query_name", "batch_id", "timestamp", "trigger_ts", "batch_duration_ms", "num_input_rows",
        "input_rows_per_second", "processed_rows_per_second", "event_time_min", "event_time_max", "watermark",
        "state_memory_bytes", "state_rows_total", "has_quality",
    )


@check("event_log_record")
def event_log_record(c: Context) -> DataFrame:
    """P5: event-log records rebuilt from typed progress rows."""
    rec = silver.event_log_record(c.prog.withColumn("details", F.lit("{}")), c.cfg)
    return rec.select(
        "id",
        F.get_json_object("sequence", "$.batch_id").cast("bigint").alias("batch_id"),
        F.get_json_object("origin", "$.flow_name").alias("flow_name"),
        F.get_json_object("origin", "$.flow_id").alias("flow_id"),
        "timestamp", "message", "level", "event_type", "maturity_level",
    )


@check("tag_enrichment")
def tag_enrichment(c: Context) -> DataFrame:
    """Business tags joined by query id, criticality default medium."""
    m = silver.streaming_metrics(c.bronze, c.cfg, c.tags)
    return m.select("id", F.get_json_object("origin", "$.flow_id").alias("query_id"), "domain", "owner", "criticality")


@check("sanitize_names")
def sanitize_names(c: Context) -> DataFrame:
    """F16: name normalisation over names built from every event."""
    from vigil.functions.core import sanitize_name

    raw = F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string")).when(F.col("event_id") % 89 == 0, F.lit("   ")).otherwise(
        F.concat(F.lit(" My "), F.col("event_type"), F.lit("/"), F.col("props"), F.lit(" "))
    )
    return c.events.select("event_id", raw.alias("raw_name")).select("event_id", "raw_name", sanitize_name("raw_name").alias("query_name"))


@check("restart_counts")
def restart_counts(c: Context) -> DataFrame:
    """Running termination count per query."""
    return c.errors.select("query_id", "timestamp", "exception_message", "restart_count")


@check("severity_tiers")
def severity_tiers(c: Context) -> DataFrame:
    """two-tier latency and batch-duration classification."""
    lat = silver.latency_ms(F.col("timestamp"), F.col("event_time_max"), c.cfg)
    return c.prog.select(
        "query_id",
        "batch_id",
        severity_tier(lat, C.SLA_LATENCY_WARNING_MS, C.SLA_LATENCY_CRITICAL_MS).alias("latency_tier"),
        severity_tier("batch_duration_ms", C.BATCH_DURATION_WARNING_MS, C.BATCH_DURATION_CRITICAL_MS).alias("duration_tier"),
    )


# ------------------------------------------------------------ overview ------

def _overview_ctx(c: Context) -> Context:
    return Context.of(c.spark, c.sf_dir, BASE.with_(as_of=AS_OF_OVERVIEW, lookback_days=None))


@check("lookback_days")
def lookback_days(c: Context) -> DataFrame:
    """Whole-day lookback (7 days before the clock, none after it)."""
    return gold.scoped(c.prog, c.cfg).select("query_id", "batch_id", "timestamp")


@check("latest_batch")
def latest_batch(c: Context) -> DataFrame:
    """A1."""
    o = _overview_ctx(c)
    return gold.latest_batch(o.prog, o.cfg)


@check("last_error")
def last_error(c: Context) -> DataFrame:
    """A2."""
    o = _overview_ctx(c)
    return gold.last_error(o.errors_raw, o.cfg)


@check("breach_counts")
def breach_counts(c: Context) -> DataFrame:
    """A3."""
    o = _overview_ctx(c)
    return gold.breach_counts(o.sla, o.cfg)


@check("stream_overview")
def stream_overview(c: Context) -> DataFrame:
    """Status, uptime, breaches, last error per stream."""
    o = _overview_ctx(c)
    return gold.stream_overview(o.prog, o.errors_raw, o.sla, o.cfg)


# -------------------------------------------------------------- trends ------

@check("throughput_trends")
def throughput_trends(c: Context) -> DataFrame:
    """A5."""
    return gold.throughput_trends(c.prog, c.cfg)


@check("latency_sla")
def latency_sla(c: Context) -> DataFrame:
    """A6 / F22."""
    return gold.latency_sla(c.sla, c.cfg)


@check("data_quality_hourly")
def data_quality_hourly(c: Context) -> DataFrame:
    """A7."""
    return gold.data_quality_hourly(c.dq, c.cfg)


@check("infra_cost_hourly")
def infra_cost_hourly(c: Context) -> DataFrame:
    """A8 (over the autoscale-annotated cluster samples)."""
    return gold.infra_cost_hourly(c.infra, c.cfg)


# -------------------------------------------------------------- frames ------

def _month(c: Context) -> Context:
    return Context.of(c.spark, c.sf_dir, BASE.with_(lookback_days=30))


@check("backpressure")
def backpressure(c: Context) -> DataFrame:
    """Sustained backpressure status per batch."""
    m = _month(c)
    return gold.backpressure(m.prog, m.cfg)


@check("state_operator_totals")
def state_operator_totals(c: Context) -> DataFrame:
    """State memory / rows folded over the state operators."""
    m = _month(c)
    return gold.state_operator_totals(m.prog, m.cfg).drop("query_name")


@check("state_store_health")
def state_store_health(c: Context) -> DataFrame:
    """W2 / P13."""
    m = _month(c)
    return gold.state_store_health(m.prog, m.cfg)


# -------------------------------------------------------------- alerts ------

DAY = 24 * 60
WEEK = 7 * DAY
MONTH = 30 * DAY


@check("alert_sla_breach")
def alert_sla_breach(c: Context) -> DataFrame:
    """Alert 1 (A10, P10, P11, P15) over a one-day lookback."""
    return alerts.sla_breach(c.sla, c.cfg, lookback_minutes=DAY)


@check("alert_backpressure")
def alert_backpressure(c: Context) -> DataFrame:
    """Alert 2 (W3, A9, P14): newest 5 batches, fires at 4."""
    return alerts.sustained_backpressure(c.prog, c.cfg, lookback_minutes=WEEK, min_count=4)


@check("alert_duration_spike")
def alert_duration_spike(c: Context) -> DataFrame:
    """Alert 3 (W4, O3): top 10 duration spikes over 30 days."""
    return alerts.duration_spike(c.prog, c.cfg, lookback_minutes=MONTH)


@check("alert_terminated")
def alert_terminated(c: Context) -> DataFrame:
    """Alert 4 (O5) over a one-day lookback."""
    return alerts.stream_terminated(c.errors, c.cfg, lookback_minutes=DAY)


@check("alert_state_growth")
def alert_state_growth(c: Context) -> DataFrame:
    """Alert 5 (W5-W7, A11) over 7 days."""
    return alerts.state_growth(c.prog, c.cfg, lookback_minutes=WEEK)


# ------------------------------------------------------- expectations -------

@check("expectation_counts")
def expectation_counts(c: Context) -> DataFrame:
    """Warn-mode violation counts of the pipeline's rules."""
    from vigil.operators import expect

    bronze = expect.violation_counts(c.bronze, expect.BRONZE_RULES + expect.SILVER_METRICS_RULES)
    sla = expect.violation_counts(c.sla, expect.SLA_RULES)
    return bronze.unionByName(sla)


@check("expectation_drop")
def expectation_drop(c: Context) -> DataFrame:
    """Kept / dropped counts of the error-event drop rule."""
    from vigil.operators import expect

    return expect.drop_counts(c.bronze, expect.ERROR_DROP_RULE)


# ------------------------------------------------------------ quality -------

@check("null_rates")
def null_rates(c: Context) -> DataFrame:
    """Per (cluster, hour) null rate of the infrastructure gauges."""
    from vigil.operators import quality

    df = c.infra.withColumn("hour", F.date_trunc("HOUR", "timestamp"))
    r = quality.null_rates(df, ["cluster_id", "hour"], ["cpu_usage_percent", "dbu_consumption", "autoscaling_event"])
    m = F.col("null_rate_by_column")
    return r.select(
        "cluster_id", "hour", "record_count",
        m["cpu_usage_percent"].alias("cpu_null_rate"), m["dbu_consumption"].alias("dbu_null_rate"), m["autoscaling_event"].alias("autoscale_null_rate"),
    )


@check("duplicate_rate")
def duplicate_rate(c: Context) -> DataFrame:
    """Per (stream, hour) share of rows repeating a user id."""
    from vigil.operators import quality
    from vigil.sources.progress_log import batch_number

    df = c.events.withColumn("batch_id", batch_number(F.col("ts").cast("timestamp")))
    return quality.duplicate_rate(df, ["event_type", "batch_id"], ["user_id"])


@check("schema_drift")
def schema_drift(c: Context) -> DataFrame:
    """Key-set change of the progress documents between batches."""
    from vigil.operators import quality

    prog = c.bronze.filter(F.col("event_type") == "stream_progress").select(
        F.get_json_object("origin", "$.flow_id").alias("query_id"),
        F.get_json_object("sequence", "$.batch_id").cast("bigint").alias("batch_id"),
        F.get_json_object("details", "$.stream_progress").alias("doc"),
    )
    d = quality.schema_drift(prog, "query_id", "batch_id", F.col("doc"), c.cfg.frame_block_rows, F.floor(F.col("batch_id") / c.cfg.batch_id_chunk))
    return d.drop("key_set")


def _order_arrivals(c: Context) -> DataFrame:
    return c.table("orders").select(
        F.col("o_orderstatus").alias("stream"),
        F.floor(F.col("o_orderkey") / 1024).cast("bigint").alias("batch_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
    )


@check("late_fraction")
def late_fraction(c: Context) -> DataFrame:
    """Orders arriving in order-key batches of 1 024, event time = order
    date, watermark delay 365 days, per order status."""
    from vigil.operators import quality

    return quality.late_fraction(_order_arrivals(c), "stream", "batch_id", "event_time", 365 * 86400, F.floor(F.col("batch_id") / 64))


@check("late_fraction_stream")
def late_fraction_stream(c: Context) -> DataFrame:
    """T7 live: the same orders arriving in three drops of a stream, late rows
    counted against marks carried between micro-batches."""
    from vigil.streaming import flows

    base = _run_dir(c, "lateness")
    o = _order_arrivals(c)
    third = o.agg(F.max("batch_id")).first()[0] // 3 + 1
    for k in range(3):
        o.filter(F.floor(F.col("batch_id") / third) == k).write.mode("append").parquet(f"{base}/landing")
        source = c.spark.readStream.schema(o.schema).parquet(f"{base}/landing")
        flows.run_lateness_stream(source, f"{base}/late", f"{base}/marks", f"{base}/_ckpt", "stream", "batch_id", "event_time", 365 * 86400)
    return c.spark.read.parquet(f"{base}/late").drop("micro_batch")


# ------------------------------------------------------- inspection ---------

@check("recent_metrics")
def recent_metrics(c: Context) -> DataFrame:
    """Newest 20 progress rows."""
    from vigil.operators import maintain

    return maintain.latest(c.prog.select("query_id", "query_name", "batch_id", "timestamp", "input_rows_per_second", "batch_duration_ms"), 20, ["timestamp", "query_id"])


@check("recent_sla")
def recent_sla(c: Context) -> DataFrame:
    """Newest 20 SLA rows."""
    from vigil.operators import maintain

    return maintain.latest(c.sla.select("query_id", "query_name", "batch_id", "timestamp", "latency_ms", "sla_breach_flag"), 20, ["timestamp", "query_id"])


@check("recent_quality")
def recent_quality(c: Context) -> DataFrame:
    """Newest 10 quality rows."""
    from vigil.operators import maintain

    return maintain.latest(c.dq.select("query_id", "batch_id", "timestamp", "duplicate_rate", "dropped_record_count", "late_record_percentage"), 10, ["timestamp", "query_id"])


@check("table_row_counts")
def table_row_counts(c: Context) -> DataFrame:
    """Row count of every monitoring table."""
    from vigil.operators import maintain

    return maintain.row_counts(
        {"raw_events": c.bronze, "streaming_metrics": c.metrics, "stream_errors": c.errors_raw, "sla_latency_metrics": c.sla,
         "data_quality_metrics": c.dq, "infrastructure_metrics": c.infra}
    )


# -------------------------------------------------------------- infra -------

@check("infra_usage_normalize")
def infra_usage_normalize(c: Context) -> DataFrame:
    """Usage rows -> infrastructure rows (7-day lookback, cluster known)."""
    from vigil.operators import infra
    from vigil.sources import progress_log

    u = infra.usage_to_infrastructure(progress_log.usage_rows(c.events), c.cfg)
    return u.drop("ingestion_ts")


@check("autoscale_events")
def autoscale_events(c: Context) -> DataFrame:
    """Scale-up / scale-down between consecutive samples of a cluster."""
    return c.infra.select("cluster_id", "sample_id", "timestamp", "executor_count", "autoscaling_event")


@check("autoscale_events_split")
def autoscale_events_split(c: Context) -> DataFrame:
    """S9 with tiny blocks and one-hour chunks: every cluster is split into
    many blocks, so the halo rows decide the first lag of each block."""
    from vigil.operators import infra
    from vigil.sources import progress_log

    cfg = c.cfg.with_(frame_block_rows=7, time_chunk_seconds=3600)
    s = infra.autoscale_events(progress_log.cluster_samples(c.events), cfg, order=("timestamp", "sample_id"))
    return s.select("cluster_id", "sample_id", "timestamp", "executor_count", "autoscaling_event")


@check("backpressure_split")
def backpressure_split(c: Context) -> DataFrame:
    """W1 with 7-row blocks and 50-batch chunks (halo path exercised)."""
    m = Context.of(c.spark, c.sf_dir, BASE.with_(lookback_days=30, frame_block_rows=7, batch_id_chunk=50))
    return gold.backpressure(m.prog, m.cfg)


# ---------------------------------------------------------- evaluation ------

def _evaluations(c: Context) -> DataFrame:
    from vigil.operators import evaluate as ev

    at = AS_OF_END
    sla = ev.to_evaluations(alerts.sla_breach(c.sla, c.cfg, lookback_minutes=DAY), "alert_sla_breach", "query_name", "breach_count", at)
    bp = ev.to_evaluations(alerts.sustained_backpressure(c.prog, c.cfg, lookback_minutes=WEEK, min_count=0), "alert_sustained_backpressure", "query_name", "backpressured_count", at)
    sp = alerts.duration_spike_candidates(c.prog, c.cfg, lookback_minutes=MONTH)
    sp = sp.withColumn("_e", F.concat_ws("/", "query_name", F.col("batch_id").cast("string")))
    sp = ev.to_evaluations(sp, "alert_batch_duration_spike", "_e", "raw_spike_factor", at)
    te = ev.to_evaluations(alerts.stream_terminated(c.errors_raw, c.cfg, lookback_minutes=DAY), "alert_stream_terminated", "query_id", None, at, count=True)
    gr = ev.to_evaluations(alerts.state_growth(c.prog, c.cfg, lookback_minutes=WEEK, pct=-1e300), "alert_state_memory_growth", "query_name", "growth_pct", at)
    return sla.unionByName(bp).unionByName(sp).unionByName(te).unionByName(gr)


@check("alert_evaluate")
def alert_evaluate(c: Context) -> DataFrame:
    """Every detector's rows tested against its rule."""
    from vigil.operators import evaluate as ev

    e = ev.evaluate(_evaluations(c), ev.rules_df(c.spark))
    return e.select("name", "entity", "value", "threshold", "severity", "fired")


@check("alert_routing")
def alert_routing(c: Context) -> DataFrame:
    """Fired alerts with channel and message."""
    from vigil.operators import evaluate as ev

    e = ev.evaluate(_evaluations(c))
    return ev.route(e, ev.escalation_df(c.spark), c.cfg.environment).select("name", "entity", "severity", "channel", "message")


def _backtest(c: Context) -> DataFrame:
    from vigil.operators import evaluate as ev

    breaches = c.sla.filter(F.col("sla_breach_flag") & (F.col("environment") == c.cfg.environment))
    counts = ev.backtest_counts(breaches, "alert_sla_breach", "query_name", 10, 300, "2024-01-01 00:00:00", AS_OF_END)
    return ev.evaluate(counts)


@check("alert_backtest")
def alert_backtest(c: Context) -> DataFrame:
    """The SLA-breach alert replayed every 5 minutes over the month."""
    return _backtest(c).select("name", "entity", "evaluated_at", "value", "fired")


@check("alert_rearm")
def alert_rearm(c: Context) -> DataFrame:
    """Which back-tested firings notify under the 600 s re-arm."""
    from vigil.operators import evaluate as ev

    return ev.rearm(_backtest(c).filter(F.col("fired")))


# ---------------------------------------------------------- lifecycle -------

def _table_location(c: Context, stem: str) -> tuple[str, str]:
    import uuid

    from vigil.session import scratch_dir

    tag = uuid.uuid4().hex[:12]
    return f"vigil_{stem}_{tag}", scratch_dir(c.spark, f"tables/{stem}_{tag}")


@check("retention_filter")
def retention_filter(c: Context) -> DataFrame:
    """Bronze stored by day; partitions older than 20 days before the
    clock dropped; rows per remaining day."""
    from vigil import schemas
    from vigil.operators import maintain

    name, loc = _table_location(c, "raw_events")
    maintain.create_table(c.spark, name, schemas.EVENT_LOG_READ, loc, "bronze event log")
    maintain.append(c.bronze, name)
    maintain.apply_retention(c.spark, name, AS_OF_END, 20)
    return c.spark.table(name).groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))


@check("compaction_preserves_rows")
def compaction_preserves_rows(c: Context) -> DataFrame:
    """K9: the many small files of each day rewritten as one batch; per day the
    row count and id range are unchanged."""
    from vigil import schemas
    from vigil.operators import maintain

    name, loc = _table_location(c, "metrics")
    maintain.create_table(c.spark, name, schemas.EVENT_LOG_READ, loc, "bronze event log")
    maintain.append(c.bronze.repartition(16), name)
    maintain.compact(c.spark, name, maintain.CLUSTER_BY["streaming_metrics"])
    return c.spark.table(name).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("distinct_ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id")
    )


@check("clustered_layout")
def clustered_layout(c: Context) -> DataFrame:
    """K9 by several columns: the SLA rows in one table compacted by
    (latency_ms, timestamp) in Z order and in another in linear order; rows
    per stream of the first, and whether a filter on the second column then
    touches less than two thirds of the share of files it touches in the second
    (from the range of values in each file)."""
    from vigil import schemas
    from vigil.operators import maintain

    tables, rows = {}, c.sla.withColumn("event_date", F.date_trunc("MONTH", "timestamp").cast("date"))
    for layout in ("linear", "z"):
        tables[layout], loc = _table_location(c, f"layout_{layout}")
        maintain.create_table(c.spark, tables[layout], schemas.SLA_LATENCY_METRICS, loc)
        maintain.insert_batch(rows.repartition(64), tables[layout], "load-0")
        maintain.compact(c.spark, tables[layout], ["latency_ms", "timestamp"], target_file_bytes=24 * 1024, layout=layout)
    stored = {k: c.spark.table(t) for k, t in tables.items()}
    ends = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    instants = [ends[0] + (ends[1] - ends[0]) * (i / 16) for i in range(1, 16)]
    share = {k: maintain.files_touched(df, "timestamp", instants) for k, df in stored.items()}
    per_stream = stored["z"].groupBy("query_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"), F.sum("latency_ms").alias("total_latency_ms")
    )
    return per_stream.withColumn("fewer_files_by_time", F.lit(3 * share["z"] < 2 * share["linear"]))


@check("streamed_table_lifecycle")
def streamed_table_lifecycle(c: Context) -> DataFrame:
    """S2 / K9 / K10 on one table: the errors flow streams into a catalog
    table, which is then pruned and compacted, streamed into again and
    compacted again; rows per day that remain."""
    from vigil import schemas
    from vigil.operators import maintain
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "lifecycle")
    name, loc = _table_location(c, "errors")
    maintain.create_table(c.spark, name, schemas.STREAM_ERRORS, loc, "stream errors")
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, f"{base}/bronze")
        flows.run_silver_flow(c.spark, f"{base}/bronze", None, f"{base}/_ckpt", "stream_errors", c.cfg, to_table=name)
        maintain.apply_retention(c.spark, name, AS_OF_END, 20)
        maintain.compact(c.spark, name, maintain.CLUSTER_BY["stream_errors"])
    return c.spark.table(name).groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("exception_message").alias("distinct_messages"))


# ---------------------------------------------------------- streaming -------
# Inputs are dropped in event-time order, in 10-day slices (one append each);
# after every drop the stream is drained with availableNow against the same
# checkpoint, as a scheduled job would.  Outputs are read back from the sink.

SLICE_DAYS = 10


def _run_dir(c: Context, stem: str) -> str:
    import uuid

    from vigil.session import scratch_dir

    return scratch_dir(c.spark, f"runs/{stem}_{uuid.uuid4().hex[:12]}")


def _time_slices(df: DataFrame, ts) -> list[DataFrame]:
    from vigil.sources.progress_log import EPOCH

    k = F.floor((F.unix_seconds(ts) - F.lit(EPOCH)) / F.lit(SLICE_DAYS * 86400))
    ids = sorted(r[0] for r in df.select(k.alias("_k")).distinct().collect())
    return [df.filter(k == i) for i in ids]


def _sensor_runs(c: Context, aggregate: bool = True) -> tuple[str, str]:
    from vigil.streaming import sensors

    base = _run_dir(c, "sensors")
    landing, bronze, gold = f"{base}/landing", f"{base}/bronze", f"{base}/gold"
    readings = sensors.readings_from_events(c.events)
    for part in _time_slices(readings, F.to_timestamp("event_time")):
        sensors.write_landing(part, landing)
        sensors.run_ingest(c.spark, landing, bronze, f"{base}/_ckpt_ingest")
        if aggregate:
            sensors.run_aggregation(c.spark, bronze, gold, f"{base}/_ckpt_agg")
    return bronze, gold


@check("sensor_ingest")
def sensor_ingest(c: Context) -> DataFrame:
    """JSON landing zone -> bronze (typed event time)."""
    from vigil import schemas

    bronze, _ = _sensor_runs(c, aggregate=False)
    return c.spark.read.schema(schemas.SENSOR_BRONZE).parquet(bronze).drop("ingestion_ts")


@check("incremental_equals_batch")
def incremental_equals_batch(c: Context) -> DataFrame:
    """T5: three availableNow drains against one checkpoint give the same
    rows as one batch read: counts per region and day."""
    from vigil import schemas

    bronze, _ = _sensor_runs(c, aggregate=False)
    b = c.spark.read.schema(schemas.SENSOR_BRONZE).parquet(bronze)
    return b.groupBy("region", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct("sensor_id").alias("distinct_sensors")
    )


@check("sensor_window_agg")
def sensor_window_agg(c: Context) -> DataFrame:
    """Sliding-window aggregate emitted in append
    mode; averages shown to 6 decimals (summation order differs between
    engines)."""
    from vigil import schemas
    from vigil.functions.core import round_half_up

    _, gold = _sensor_runs(c)
    g = c.spark.read.schema(schemas.SENSOR_GOLD).parquet(gold)
    return g.withColumn("avg_temperature", round_half_up("avg_temperature", 6)).withColumn("avg_humidity", round_half_up("avg_humidity", 6))


@check("sensor_generate")
def sensor_generate(c: Context) -> DataFrame:
    """One generated reading per event, around the event's time."""
    from vigil.streaming import sensors

    return sensors.generate_readings(c.events.withColumn("_base", F.col("ts").cast("timestamp")), "event_id", "_base")


@check("foreach_batch_quality")
def foreach_batch_quality(c: Context) -> DataFrame:
    """Quality measured on each real micro-batch inside foreachBatch."""
    from vigil.streaming import flows, sensors

    base = _run_dir(c, "quality")
    landing, out = f"{base}/landing", f"{base}/quality"
    for part in _time_slices(sensors.readings_from_events(c.events), F.to_timestamp("event_time")):
        sensors.write_landing(part, landing)
        flows.run_quality_stream(sensors.bronze_stream(c.spark, landing), out, f"{base}/_ckpt")
    return c.spark.read.parquet(out).drop("batch_id")


def _progress_runs(c: Context) -> tuple[str, list[str]]:
    """Bronze log dropped in slices; the streaming backpressure flow drained
    after each drop.  Returns the output folder and the query id of each
    run."""
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "progress")
    bronze, out = f"{base}/bronze", f"{base}/backpressure"
    ids = []
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, bronze)
        q = flows.run_backpressure_stream(c.spark, bronze, out, f"{base}/_ckpt", c.cfg, max_files_per_trigger=None)
        ids.append(str(q.id))
    return out, ids


@check("backpressure_stream")
def backpressure_stream(c: Context) -> DataFrame:
    """Sustained backpressure on the live progress stream (per-stream
    state, applyInPandasWithState) equals the batch row frame."""
    from vigil.streaming.state import OUTPUT

    return c.spark.read.schema(OUTPUT).parquet(_progress_runs(c)[0]).drop("query_id")


@check("listener_capture")
def listener_capture(c: Context) -> DataFrame:
    """A listener captures the progress of a running query into
    bronze; the captured log is parsed by silver.  Rows-only."""
    from vigil.sources.event_log import read_event_log
    from vigil.streaming.listener import ProgressCapture, wait_for_termination

    cap_dir = _run_dir(c, "capture")
    cap = ProgressCapture(c.spark, cap_dir, c.cfg, background=False)
    c.spark.streams.addListener(cap)
    try:
        _, ids = _progress_runs(c)
        # the listener bus is asynchronous: a query's termination event comes
        # after all of its progress events
        for qid in set(ids):
            wait_for_termination(cap, qid, runs=ids.count(qid))
    finally:
        c.spark.streams.removeListener(cap)
        cap.stop()
    captured = read_event_log(c.spark, cap_dir)
    p = silver.progress(captured, c.cfg)
    return p.select("query_name", "batch_id", "num_input_rows")


# ---------------------------------------------------------- pipeline --------

@check("materialize_datasets")
def materialize_datasets(c: Context) -> DataFrame:
    """K5: silver and gold datasets written once (silver by day), gold built
    from the stored silver tables; the stored stream overview read back."""
    from vigil.plans import datasets

    from vigil.sources.event_log import append_event_log, read_event_log

    o = _overview_ctx(c)
    root = _run_dir(c, "pipeline")
    append_event_log(c.bronze, f"{root}/raw_events")
    bronze = read_event_log(c.spark, f"{root}/raw_events")
    need = {"stream_progress", "stream_errors", "sla_latency_metrics", "mv_stream_overview"}
    paths = datasets.materialize(c.spark, bronze, root, o.cfg, names=need)
    return c.spark.read.parquet(paths["mv_stream_overview"])


@check("silver_flow_stream")
def silver_flow_stream(c: Context) -> DataFrame:
    """The SLA silver flow run as a stream over the bronze log (dropped
    in slices, drained with availableNow) equals the batch silver table."""
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "silver_flow")
    bronze, out = f"{base}/bronze", f"{base}/sla"
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, bronze)
        flows.run_silver_flow(c.spark, bronze, out, f"{base}/_ckpt", "sla_latency_metrics", c.cfg)
    return c.spark.read.parquet(out).drop("ingestion_ts", "event_date", "write_batch")


@check("monitoring_tables")
def monitoring_tables(c: Context) -> DataFrame:
    """K6 / K7 / K8: DDL for every monitoring table, silver rows inserted
    through the catalog, tables listed and counted."""
    import uuid

    from vigil.operators import maintain
    from vigil.streaming import sensors

    db = f"vigil_mon_{uuid.uuid4().hex[:10]}"
    root = _run_dir(c, "catalog")
    maintain.create_monitoring_tables(c.spark, db, root)
    maintain.append(c.bronze, f"{db}.raw_events")
    maintain.append(c.metrics, f"{db}.streaming_metrics")
    maintain.append(c.errors, f"{db}.stream_errors")
    maintain.append(c.sla, f"{db}.sla_latency_metrics")
    maintain.append(c.dq, f"{db}.data_quality_metrics")
    maintain.append(c.infra, f"{db}.infrastructure_metrics")
    readings = sensors.readings_from_events(c.events).withColumn("event_time", F.to_timestamp("event_time")).withColumn("ingestion_ts", F.current_timestamp())
    maintain.append(readings, f"{db}.sensor_bronze", ts="event_time")
    names = maintain.list_tables(c.spark, db)
    return maintain.row_counts({n: c.spark.table(f"{db}.{n}") for n in names})


# ------------------------------------------------------ dashboard SQL -------

def _ranked(c: Context, df: DataFrame) -> DataFrame:
    """``display_rank``: place of each row in the order it is delivered in.

    The ordered result is written with each row's partition and place in it;
    the rows of earlier partitions are added from a count per partition, so
    only that list of counts is ever ordered as a whole."""
    from pyspark.sql import Window

    place = F.monotonically_increasing_id()
    out = _run_dir(c, "display")
    df.withColumn("_part", F.shiftright(place, 33)).withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))).write.parquet(out)
    rows = c.spark.read.parquet(out)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(earlier, F.lit(0)).alias("_off"))
    return rows.join(offsets, "_part").withColumn("display_rank", (F.col("_off") + F.col("_place") + 1).cast("int")).drop("_part", "_place", "_off")


#: check -> its read before ranks are added
SQL_READS: dict[str, Callable[[Context], DataFrame]] = {}


def _sql_check(name: str, dataset: str, context, **params):
    def read(c: Context) -> DataFrame:
        from vigil.plans import dashboard_sql

        m = context(c)
        views = {"stream_progress": m.prog, "stream_errors": m.errors if dataset == "alert_stream_terminated" else m.errors_raw, "sla_latency_metrics": m.sla, "data_quality_metrics": m.dq, "infrastructure_metrics": m.infra}
        return dashboard_sql.run(c.spark, dataset, views, m.cfg, **params)

    def fn(c: Context) -> DataFrame:
        return _ranked(c, read(c))

    SQL_READS[name] = read
    fn.__doc__ = f"P20 / O1 / O2 / O5: the {dataset} read as parameterised Spark SQL, in display order."
    check(name)(fn)


_sql_check("sql_stream_overview", "stream_overview", _overview_ctx)
for _name in ("throughput_trends", "latency_sla", "data_quality_hourly", "infra_cost_hourly"):
    _sql_check(f"sql_{_name}", _name, lambda c: c)
for _name in ("backpressure", "state_store_health"):
    _sql_check(f"sql_{_name}", _name, _month)


@check("alert_backtest_terminated")
def alert_backtest_terminated(c: Context) -> DataFrame:
    """The termination alert (COUNT per query, 10-minute lookback)
    replayed every minute over the month."""
    from vigil.operators import evaluate as ev

    e = c.errors_raw.filter(F.col("environment") == c.cfg.environment)
    counts = ev.backtest_counts(e, "alert_stream_terminated", "query_id", 10, 60, "2024-01-01 00:00:00", AS_OF_END)
    return ev.evaluate(counts).select("name", "entity", "evaluated_at", "value", "fired")


@check("alert_backtest_state_growth")
def alert_backtest_state_growth(c: Context) -> DataFrame:
    """The state-growth alert replayed every 10 minutes with a 3-hour
    lookback (hourly batches)."""
    from vigil.operators import evaluate as ev

    p = c.prog.filter(F.col("environment") == c.cfg.environment)
    g = ev.backtest_state_growth(p, 180, 600, "2024-01-01 00:00:00", AS_OF_END)
    return ev.evaluate(g).select("name", "entity", "evaluated_at", "value", "fired")


@check("alert_backtest_backpressure")
def alert_backtest_backpressure(c: Context) -> DataFrame:
    """Alert 2 replayed hourly with a 6-hour lookback."""
    from vigil.operators import evaluate as ev

    p = c.prog.filter(F.col("environment") == c.cfg.environment)
    g = ev.backtest_backpressure(p, 360, 3600, "2024-01-01 00:00:00", AS_OF_END)
    return ev.evaluate(g).select("name", "entity", "evaluated_at", "value", "fired")


@check("alert_backtest_duration_spike")
def alert_backtest_duration_spike(c: Context) -> DataFrame:
    """Alert 3 replayed hourly with a 24-hour lookback."""
    from vigil.operators import evaluate as ev

    p = c.prog.filter(F.col("environment") == c.cfg.environment)
    g = ev.backtest_duration_spike(p, 1440, 3600, "2024-01-01 00:00:00", AS_OF_END)
    return ev.evaluate(g).select("name", "entity", "evaluated_at", "value", "fired")


@check("throughput_trends_stream")
def throughput_trends_stream(c: Context) -> DataFrame:
    """Per-minute throughput trends maintained by a stream with a
    10-minute watermark (append mode), bronze dropped in slices."""
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "trends_stream")
    bronze, out = f"{base}/bronze", f"{base}/trends"
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, bronze)
        flows.run_throughput_stream(c.spark, bronze, out, f"{base}/_ckpt", c.cfg)
    return c.spark.read.parquet(out)


@check("latency_sla_stream")
def latency_sla_stream(c: Context) -> DataFrame:
    """T3 + A6: latency percentiles per 5-minute bucket kept in streaming
    state (10-minute watermark, append mode)."""
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "latency_stream")
    bronze, out = f"{base}/bronze", f"{base}/latency"
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, bronze)
        flows.run_latency_stream(c.spark, bronze, out, f"{base}/_ckpt", c.cfg)
    return c.spark.read.parquet(out)


@check("gold_incremental_refresh")
def gold_incremental_refresh(c: Context) -> DataFrame:
    """SURVEY §4 incremental refresh: half of the log processed (silver
    flows, full gold), then the rest appended and only its days refreshed
    (dynamic partition overwrite); the stored throughput trends equal a full
    recompute."""
    import datetime as dt

    from vigil import jobs
    from vigil.sources.event_log import append_event_log

    cfg = c.cfg.with_(lookback_days=None)
    root = _run_dir(c, "incremental")
    raw, lake = f"{root}/raw_events", f"{root}/lake"
    day = F.to_date("timestamp")
    days = sorted(r[0] for r in c.bronze.select(day.alias("d")).distinct().collect())
    cut = days[len(days) // 2]
    append_event_log(c.bronze.filter(day < F.lit(cut)), raw)
    jobs.pipeline(c.spark, raw, lake, cfg)
    append_event_log(c.bronze.filter(day >= F.lit(cut)), raw)
    jobs.pipeline(c.spark, raw, lake, cfg, days=[d for d in days if d >= cut])
    assert all(isinstance(d, dt.date) for d in days)
    return c.spark.read.parquet(f"{lake}/mv_throughput_trends").drop("event_date")


def _delta_lake(c: Context, cfg) -> str:
    """A lake built from half of the log, then refreshed by delta with the
    other half; half a day in the middle of the first arrives late."""
    from vigil.plans import datasets
    from vigil.sources.event_log import append_event_log, read_event_log

    root = _run_dir(c, "delta")
    day = F.to_date("timestamp")
    days = sorted(r[0] for r in c.bronze.select(day.alias("d")).distinct().collect())
    cut, late = days[len(days) // 2], days[len(days) // 4]
    first = (day < F.lit(cut)) & ~((day == F.lit(late)) & (F.hour("timestamp") >= 12))
    append_event_log(c.bronze.filter(first), f"{root}/raw")
    datasets.materialize(c.spark, read_event_log(c.spark, f"{root}/raw"), root, cfg)
    append_event_log(c.bronze.filter(~first), f"{root}/raw")
    bronze = read_event_log(c.spark, f"{root}/raw")
    datasets.materialize(c.spark, bronze, root, cfg, layers=("silver",))
    datasets.refresh(c.spark, root, cfg, [late] + [d for d in days if d >= cut])
    return root


@check("overview_by_delta")
def overview_by_delta(c: Context) -> DataFrame:
    """K5 / A4: the overview merged from stored partials per day after a
    refresh with late and new days, at a clock inside a day."""
    o = _overview_ctx(c)
    return c.spark.read.parquet(f"{_delta_lake(c, o.cfg.with_(lookback_days=None))}/mv_stream_overview")


@check("backpressure_by_delta")
def backpressure_by_delta(c: Context) -> DataFrame:
    """Frames of refreshed days read the stored tails of other days
    and equal a full recompute over all days."""
    return c.spark.read.parquet(f"{_delta_lake(c, c.cfg.with_(lookback_days=None))}/mv_backpressure").drop("event_date")


@check("state_growth_by_delta")
def state_growth_by_delta(c: Context) -> DataFrame:
    """As ``backpressure_by_delta`` for the state growth."""
    return c.spark.read.parquet(f"{_delta_lake(c, c.cfg.with_(lookback_days=None))}/mv_state_store_health").drop("event_date")


@check("infrastructure_datasets")
def infrastructure_datasets(c: Context) -> DataFrame:
    """Cluster gauges materialised as silver by day, the hourly cost
    built from the stored table."""
    from vigil.plans import datasets
    from vigil.sources import progress_log

    root = _run_dir(c, "infra")
    samples = progress_log.cluster_samples(c.events, c.cfg.environment)
    names = {"infrastructure_metrics", "mv_infrastructure_cost"}
    paths = datasets.materialize(c.spark, None, root, c.cfg, names=names, samples=samples)
    return c.spark.read.parquet(paths["mv_infrastructure_cost"]).drop("event_date")


# --------------------------------------------------------- alert SQL --------

_sql_check("sql_alert_sla_breach", "alert_sla_breach", lambda c: c, lookback_minutes=DAY)
_sql_check("sql_alert_backpressure", "alert_sustained_backpressure", lambda c: c, lookback_minutes=WEEK, min_count=4)
_sql_check("sql_alert_duration_spike", "alert_batch_duration_spike", lambda c: c, lookback_minutes=MONTH)
_sql_check("sql_alert_terminated", "alert_stream_terminated", lambda c: c, lookback_minutes=DAY)
_sql_check("sql_alert_state_growth", "alert_state_memory_growth", lambda c: c, lookback_minutes=WEEK)


@check("observed_metrics")
def observed_metrics(c: Context) -> DataFrame:
    """Every named observation of every batch, long format."""
    return silver.observed_metrics(c.bronze, c.cfg).drop("environment")


@check("data_quality_stream")
def data_quality_stream(c: Context) -> DataFrame:
    """T3 + A7: hourly data-quality buckets kept in streaming state
    (10-minute watermark, append mode)."""
    from vigil.sources.event_log import append_event_log
    from vigil.streaming import flows

    base = _run_dir(c, "quality_stream")
    bronze, out = f"{base}/bronze", f"{base}/quality"
    for part in _time_slices(c.bronze, F.col("timestamp")):
        append_event_log(part, bronze)
        flows.run_quality_hourly_stream(c.spark, bronze, out, f"{base}/_ckpt", c.cfg)
    return c.spark.read.parquet(out)


# ------------------------------------------- live detectors, as-of, rollups --

LIVE_DELAY = "2190 minutes"


def _disordered_drops(c: Context) -> list[DataFrame]:
    """The bronze log in 10-day drops, where every third batch arrives a day
    late (so that it often comes with the next drop)."""
    from vigil.sources.progress_log import EPOCH

    arrival = F.unix_seconds("timestamp") + F.when(F.col("batch_id") % 3 == 0, 86400).otherwise(0)
    k = F.floor((arrival - F.lit(EPOCH)) / F.lit(SLICE_DAYS * 86400))
    rows = c.bronze.withColumn("batch_id", F.get_json_object("sequence", "$.batch_id").cast("bigint"))
    ids = sorted(r[0] for r in rows.select(k.alias("_k")).distinct().collect())
    return [rows.filter(k == i).drop("batch_id") for i in ids]


def _drain_drops(c: Context, stem: str, run, cfg) -> str:
    from vigil.sources.event_log import append_event_log

    base = _run_dir(c, stem)
    for part in _disordered_drops(c):
        append_event_log(part, f"{base}/bronze")
        run(c.spark, f"{base}/bronze", f"{base}/out", f"{base}/_ckpt", cfg, LIVE_DELAY)
    return f"{base}/out"


@check("duration_spike_stream")
def duration_spike_stream(c: Context) -> DataFrame:
    """Spikes found on the live stream while batches arrive up to a
    day out of order, for every batch the final watermark has passed."""
    from vigil.streaming import flows

    return c.spark.read.parquet(_drain_drops(c, "spike_stream", flows.run_spike_stream, c.cfg))


@check("stream_status_changes")
def stream_status_changes(c: Context) -> DataFrame:
    """A4 live: when each stream became ACTIVE and, by a timer, INACTIVE
    (no batch for over an hour), up to the final watermark."""
    from vigil.streaming import flows

    return c.spark.read.parquet(_drain_drops(c, "status_stream", flows.run_status_stream, c.cfg.with_(inactivity_minutes=60)))


@check("tags_as_of")
def tags_as_of(c: Context) -> DataFrame:
    """J3 in time: each batch with the tags in force at its own time."""
    from vigil.operators import asof

    return asof.with_tags_as_of(c.prog, c.tag_history, c.cfg).select("query_id", "batch_id", "timestamp", "domain", "owner", "criticality")


def _stored_sketches(c: Context) -> DataFrame:
    out = f"{_run_dir(c, 'sketches')}/latency_sketches"
    gold.latency_sketches(c.sla, c.cfg.with_(lookback_days=None)).write.parquet(out)
    return c.spark.read.parquet(out)


@check("latency_rollup_day")
def latency_rollup_day(c: Context) -> DataFrame:
    """Daily percentiles merged from stored 5-minute sketches (a
    day's sketch holds few enough batches to be exact)."""
    return gold.latency_from_sketches(_stored_sketches(c), "1 day")


@check("latency_rollup_range")
def latency_rollup_range(c: Context) -> DataFrame:
    """Percentiles of the whole range from stored sketches; the true
    rank of each (share of latencies up to it) is within 0.02 of the asked
    one."""
    merged = gold.latency_from_sketches(_stored_sketches(c), None)
    raw = gold.scoped(c.sla, c.cfg.with_(lookback_days=None)).filter(F.col("latency_ms").isNotNull()).select(F.col("query_name").alias("_q"), "latency_ms")
    quantiles = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    below = {p: F.avg((F.col("latency_ms") < F.col(f"{p}_latency_ms")).cast("double")) for p in quantiles}
    upto = {p: F.avg((F.col("latency_ms") <= F.col(f"{p}_latency_ms")).cast("double")) for p in quantiles}
    j = raw.join(merged, F.col("_q") == F.col("query_name"))
    # the asked rank lies between the share below the value and the share up to it
    near = [((below[p] <= q + 0.02) & (upto[p] >= q - 0.02)).alias(f"{p}_within_bound") for p, q in quantiles.items()]
    return j.groupBy("query_name", "batch_count", "breach_count", "max_latency_ms").agg(*near)


def _evolving_runs(c: Context) -> str:
    """Sensor drops of ten days whose schema changes: from the second drop on
    humidity is a text and a nested field is new, from the third on that one
    has a further field."""
    from vigil import schemas
    from vigil.streaming import evolve, sensors

    base = _run_dir(c, "evolving")
    for k, part in enumerate(_time_slices(sensors.readings_from_events(c.events), F.to_timestamp("event_time"))):
        if k >= 1:
            inner = [F.col("region").alias("channel")] + ([F.col("pressure").alias("build")] if k >= 2 else [])
            part = part.withColumns({"firmware": F.struct(*inner), "humidity": F.concat(F.col("humidity").cast("string"), F.lit(" %"))})
        part.select(F.to_json(F.struct(*part.columns)).alias("value")).write.mode("append").text(f"{base}/landing")
        evolve.run_evolving_ingest(c.spark, f"{base}/landing", f"{base}/bronze", f"{base}/schema_log", f"{base}/_ckpt", schemas.SENSOR_SOURCE)
    return base


@check("schema_changes")
def schema_changes(c: Context) -> DataFrame:
    """New fields, new types and nested paths seen by one checkpoint
    over drops of changing schema."""
    from vigil.streaming import evolve

    return evolve.schema_changes(c.spark.read.parquet(f"{_evolving_runs(c)}/schema_log").withColumn("batch_id", F.col("batch_id").cast("bigint")))


@check("evolving_ingest")
def evolving_ingest(c: Context) -> DataFrame:
    """S3 / K1: every row of those drops lands; fields that do not fit the
    declared schema are rescued."""
    rows = c.spark.read.parquet(f"{_evolving_runs(c)}/bronze")
    channel = F.get_json_object("rescued", "$.firmware.channel") == F.col("region")
    return rows.groupBy(F.to_date(F.try_to_timestamp("event_time")).alias("day"), "region").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count("humidity").alias("typed_humidity"),
        F.count(F.get_json_object("rescued", "$.humidity")).alias("rescued_humidity"),
        F.count_if(channel).alias("rescued_channel"),
        F.count(F.get_json_object("rescued", "$.firmware.build")).alias("rescued_build"),
        F.max("temperature").alias("max_temperature"),
        F.count("corrupt").alias("corrupt_lines"),
    )


@check("history_duplicates")
def history_duplicates(c: Context) -> DataFrame:
    """U3 against history: events in ten-day batches, each met with the sketch
    of all before it; repeated keys (user and whole value) counted exactly
    where the estimate is above 5 %."""
    from vigil.operators import history

    root = f"{_run_dir(c, 'history')}/events"
    rows = c.events.withColumn("whole_value", F.floor("value"))
    for k, part in enumerate(_time_slices(rows, F.col("ts").cast("timestamp"))):
        history.record_batch(part, root, k, "event_type", ["user_id", "whole_value"], tolerance=0.05, lg_entries=16)
    out = c.spark.read.parquet(f"{root}/repeats")
    return out.select(F.col("source").alias("event_type"), F.col("batch_id").cast("bigint").alias("batch_id"), "record_count", "distinct_estimate", "repeated_estimate", "confirmed", "repeated_rows")
