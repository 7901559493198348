"""Alert detectors.

Each detector returns the rows its alert would show at the clock
``cfg.as_of``; ``evaluate`` (operators/evaluate.py) turns them into firings.
Lookbacks are arguments whose defaults are the reference's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.functions.core import lookback_interval_filter, partition_days_filter, round_half_up
from vigil.operators import frames
from vigil.operators.gold import MB, backpressure_flag, batch_chunk


def _recent(df: DataFrame, cfg: MonitorConfig, minutes: int) -> DataFrame:
    cond = (F.col("environment") == F.lit(cfg.environment)) & lookback_interval_filter("timestamp", cfg.as_of, minutes)
    if "event_date" in df.columns:
        cond = cond & partition_days_filter(cfg.as_of, minutes=minutes)
    return df.filter(cond)


def sla_breach(sla: DataFrame, cfg: MonitorConfig, lookback_minutes: int = C.ALERT_LOOKBACK_MINUTES["alert_sla_breach"], min_count: int = 0) -> DataFrame:
    """Alert 1 (A10, P11, P15): breaching batches per stream in the lookback."""
    return (
        _recent(sla, cfg, lookback_minutes)
        .filter(F.col("sla_breach_flag"))
        .groupBy("query_name")
        .agg(
            F.count(F.lit(1)).alias("breach_count"),
            F.max("latency_ms").alias("max_latency_ms"),
            F.max("sla_threshold_ms").alias("sla_threshold_ms"),
        )
        .filter(F.col("breach_count") > min_count)
    )


def sustained_backpressure(
    prog: DataFrame,
    cfg: MonitorConfig,
    lookback_minutes: int = C.ALERT_LOOKBACK_MINUTES["alert_sustained_backpressure"],
    newest: int = C.BACKPRESSURE_FRAME_ROWS,
    min_count: int = C.BACKPRESSURE_CRITICAL_BATCHES,
) -> DataFrame:
    """Alert 2 (W3, A9, P14): backpressured batches among the newest
    ``newest`` batches of each stream; fires at ``min_count``.

    ``row_number() <= k`` is planned as a WindowGroupLimit: each map task
    keeps at most k rows per stream before the shuffle, so a hot stream
    ships k rows per task, not all its rows."""
    w = Window.partitionBy("query_id").orderBy(F.col("batch_id").desc())
    recent = _recent(prog, cfg, lookback_minutes).select(
        "query_id", "query_name", "batch_id", backpressure_flag().alias("is_backpressured"), F.row_number().over(w).alias("rn")
    )
    return (
        recent.filter(F.col("rn") <= newest)
        .groupBy("query_id", "query_name")
        .agg(F.sum("is_backpressured").cast("bigint").alias("backpressured_count"))
        .filter(F.col("backpressured_count") >= min_count)
        .select("query_name", "backpressured_count")
    )


def duration_spike_candidates(
    prog: DataFrame,
    cfg: MonitorConfig,
    lookback_minutes: int = C.ALERT_LOOKBACK_MINUTES["alert_batch_duration_spike"],
    factor: float = C.SPIKE_FACTOR,
    history: int = C.SPIKE_HISTORY_ROWS,
) -> DataFrame:
    """All spikes (W4): batch duration above ``factor`` times the average of
    the previous ``history`` batches of the stream (by batch id)."""
    base = _recent(prog, cfg, lookback_minutes).select("query_id", "query_name", "batch_id", "batch_duration_ms")
    rolled = frames.rows_frame(
        base,
        ["query_id"],
        ["batch_id"],
        history,
        lambda w: {"_avg": F.avg("batch_duration_ms").over(w.rowsBetween(-history, -1))},
        cfg.frame_block_rows,
        batch_chunk(cfg),
    )
    return rolled.filter((F.col("batch_duration_ms") > F.lit(factor) * F.col("_avg")) & F.col("_avg").isNotNull()).select(
        "query_id",
        "query_name",
        "batch_id",
        "batch_duration_ms",
        round_half_up("_avg", 0).alias("rolling_avg_duration_ms"),
        round_half_up(F.col("batch_duration_ms") / F.nullif(F.col("_avg"), F.lit(0.0)), 2).alias("spike_factor"),
        (F.col("batch_duration_ms") / F.nullif(F.col("_avg"), F.lit(0.0))).alias("raw_spike_factor"),
    )


def duration_spike(prog: DataFrame, cfg: MonitorConfig, top: int = 10, **kw) -> DataFrame:
    """Alert 3 (O3): the ``top`` largest spikes, ties broken by stream and
    batch (a TakeOrderedAndProject: each task keeps its own top rows)."""
    c = duration_spike_candidates(prog, cfg, **kw)
    return c.orderBy(F.col("spike_factor").desc(), "query_id", "batch_id").limit(top).select(
        "query_name", "batch_id", "batch_duration_ms", "rolling_avg_duration_ms", "spike_factor"
    )


def stream_terminated(errors: DataFrame, cfg: MonitorConfig, lookback_minutes: int = C.ALERT_LOOKBACK_MINUTES["alert_stream_terminated"]) -> DataFrame:
    """Alert 4 (O5): termination / error rows in the lookback."""
    return _recent(errors, cfg, lookback_minutes).select(
        "query_id",
        "query_name",
        F.col("timestamp").alias("terminated_at"),
        "exception_type",
        "exception_message",
        "termination_reason",
        "restart_count",
    )


def state_growth(
    prog: DataFrame,
    cfg: MonitorConfig,
    lookback_minutes: int = C.ALERT_LOOKBACK_MINUTES["alert_state_memory_growth"],
    pct: float = C.STATE_GROWTH_PERCENT,
) -> DataFrame:
    """Alert 5 (W5-W7, A11): state memory at the first and the last batch of
    the lookback, growth above ``pct`` percent.

    The reference takes FIRST_VALUE / LAST_VALUE over a whole-partition
    frame and then DISTINCT; the same values come from a ``min_by`` /
    ``max_by`` group aggregate, which pre-aggregates per task instead of
    buffering every row of a stream; the names a query had (a set of few)
    come from the same pass."""
    r = _recent(prog, cfg, lookback_minutes)
    order = F.struct("timestamp", "batch_id")
    per = r.groupBy("query_id").agg(
        F.min_by("state_memory_bytes", order).alias("_start"),
        F.max_by("state_memory_bytes", order).alias("_end"),
        F.collect_set("query_name").alias("_names"),
    )
    start = F.col("_start").cast("double")
    end = F.col("_end").cast("double")
    growth = F.try_divide(F.lit(100.0) * (end - start), start)
    return (
        per.filter((F.col("_start") > 0) & (growth > F.lit(pct)))
        .select(
            F.explode("_names").alias("query_name"),
            round_half_up(start / F.lit(MB), 2).alias("memory_start_mb"),
            round_half_up(end / F.lit(MB), 2).alias("memory_end_mb"),
            round_half_up(growth, 2).alias("growth_pct"),
        )
        .distinct()
    )
