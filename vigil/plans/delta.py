"""Refresh of the gold datasets that look across days, by delta.

Stored beside the datasets, by day:

* ``_partial_batches`` / ``_partial_errors`` / ``_partial_breaches``: partial
  aggregates per day and stream (A1-A3), which the overview merges;
* ``_tails``: the last rows of each day and stream that a row frame of a later
  day can reach (4 for W1, one with state for W2).

A refresh of N days reads those days of silver, replaces their partials and
tails, and then reads nothing but these state tables besides.  Row frames are
recomputed for the refreshed days and for the later days whose first rows look
back into them; rows of other days come from the tails.  Everything equals a
full recompute.

Frames follow batch ids, days follow timestamps.  If a stream's batch ids do
not grow from day to day (seen in the partials), its frames do not stay near
their day, and the frame datasets are computed over all days instead.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.functions.core import as_of_col
from vigil.operators import gold

REACH = {"flag": C.BACKPRESSURE_FRAME_ROWS - 1, "state": 1}
FRAMES = {"mv_backpressure": ("flag", gold.backpressure), "mv_state_store_health": ("state", gold.state_store_health)}
_TAIL_COLUMNS = ["query_id", "query_name", "batch_id", "timestamp", "environment", "input_rows_per_second", "processed_rows_per_second", "state_memory_bytes", "state_rows_total", "event_date"]


def _batches(prog: DataFrame, cfg: MonitorConfig) -> DataFrame:
    return gold.scoped(prog, cfg).groupBy("event_date", "query_id", "query_name").agg(
        F.max("timestamp").alias("last_batch_ts"),
        F.max("batch_id").alias("last_batch_id"),
        F.min("timestamp").alias("first_batch_ts"),
        F.min("batch_id").alias("first_batch_id"),
        F.count(F.lit(1)).alias("flag_rows"),
        F.count(F.when(F.col("state_memory_bytes") > 0, 1)).alias("state_rows"),
    )


def _errors(errors: DataFrame, cfg: MonitorConfig) -> DataFrame:
    return gold.scoped(errors, cfg).groupBy("event_date", "query_id").agg(F.max("timestamp").alias("last_error_ts"))


def _breaches(sla: DataFrame, cfg: MonitorConfig) -> DataFrame:
    return gold.scoped(sla, cfg).filter(F.col("sla_breach_flag")).groupBy("event_date", "query_id").agg(F.count(F.lit(1)).alias("breach_count"))


PARTIALS = {
    "_partial_batches": ("stream_progress", _batches),
    "_partial_errors": ("stream_errors", _errors),
    "_partial_breaches": ("sla_latency_metrics", _breaches),
}


def _tails(prog: DataFrame, cfg: MonitorConfig) -> DataFrame:
    """The last rows of every day and stream, per kind of frame
    (``row_number() <= k``: each task keeps k rows before the shuffle)."""
    rows = gold.scoped(prog, cfg).select(*_TAIL_COLUMNS)
    last = Window.partitionBy("event_date", "query_id").orderBy(F.col("batch_id").desc())
    flags = rows.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= REACH["flag"])
    states = rows.filter(F.col("state_memory_bytes") > 0).withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= REACH["state"])
    return flags.withColumn("kind", F.lit("flag")).unionByName(states.withColumn("kind", F.lit("state"))).drop("_n")


def _write_days(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def _read(spark: SparkSession, root: str, name: str, like: DataFrame) -> DataFrame:
    """A state table (its schema is given: a day may have no rows at all)."""
    return spark.read.schema(like.schema).parquet(os.path.join(root, name))


def write_state(inputs, cfg: MonitorConfig) -> None:
    """Partials and tails of the days that ``inputs`` covers."""
    cfg = cfg.with_(lookback_days=None)
    for name, (source, build) in PARTIALS.items():
        _write_days(build(inputs.stored(source), cfg), os.path.join(inputs.root, name))
    _write_days(_tails(inputs.stored("stream_progress"), cfg), os.path.join(inputs.root, "_tails"))


def overview(inputs, cfg: MonitorConfig) -> DataFrame:
    """A4 from the stored partials.  The clock's own day may be cut by it, so
    that one day is aggregated from silver; earlier days are partials."""
    today = F.to_date(as_of_col(cfg.as_of))
    parts = {}
    for name, (source, build) in PARTIALS.items():
        now = build(inputs.stored(source).filter(F.col("event_date") == today), cfg.with_(lookback_days=None))
        stored = _read(inputs.spark, inputs.root, name, now).filter(F.col("event_date") < today)
        if cfg.lookback_days is not None:
            stored = stored.filter(F.col("event_date") >= F.date_sub(today, cfg.lookback_days))
        parts[name] = stored.unionByName(now)
    batches = parts["_partial_batches"].groupBy("query_id", "query_name").agg(
        F.max("last_batch_ts").alias("last_batch_ts"), F.max("last_batch_id").alias("last_batch_id"), F.min("first_batch_ts").alias("first_batch_ts")
    )
    errors = parts["_partial_errors"].groupBy("query_id").agg(F.max("last_error_ts").alias("last_error_ts"))
    breaches = parts["_partial_breaches"].groupBy("query_id").agg(F.sum("breach_count").alias("breach_count"))
    return gold.overview_status(batches, errors, breaches, cfg)


def reached_days(batches: DataFrame, days: list, kind: str) -> list | None:
    """``days`` and the later days whose frames look back into one of them,
    from the row counts per day and stream; None if some stream's batch ids do
    not grow from day to day.  At most one row per day reaches the driver."""
    per = batches.groupBy("query_id", "event_date").agg(F.sum(f"{kind}_rows").alias("n"), F.min("first_batch_id").alias("lo"), F.max("last_batch_id").alias("hi"))
    w = Window.partitionBy("query_id").orderBy("event_date")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("cum", F.sum("n").over(upto)).withColumn("before", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    changed = F.col("event_date").isin(list(days))
    since = F.col("cum") - F.col("n") - F.max(F.when(changed, F.col("cum"))).over(upto)
    found = per.withColumn("hit", changed | (since < REACH[kind])).groupBy("event_date").agg(F.max("hit").alias("hit"), F.max(F.col("lo") <= F.col("before")).alias("mixed")).collect()
    if any(r["mixed"] for r in found):
        return None
    return sorted({r["event_date"] for r in found if r["hit"]} | set(days))


def frame_rows(inputs, name: str, cfg: MonitorConfig, days: list) -> DataFrame:
    """Rows of ``name`` (a row-frame dataset) for ``days``: their silver rows
    with the tails of all other days before them."""
    kind, build = FRAMES[name]
    fresh = inputs.on(days).stored("stream_progress").select(*_TAIL_COLUMNS)
    tails = _read(inputs.spark, inputs.root, "_tails", _tails(fresh, cfg))
    tails = tails.filter((F.col("kind") == kind) & ~F.col("event_date").isin(list(days)) & (F.col("event_date") < F.lit(max(days)))).drop("kind")
    out = build(fresh.unionByName(tails), cfg.with_(lookback_days=None))
    return out.withColumn("event_date", F.to_date("timestamp")).filter(F.col("event_date").isin(list(days)))


def refresh(inputs, cfg: MonitorConfig, days: list) -> dict[str, str]:
    """Replace state and results of ``days`` (and of the later days that look
    into them).  Reads silver for those days only; a re-run after a failure
    gives the same tables.  Rows stamped after the clock enter with the next
    refresh of their day."""
    out = {}
    write_state(inputs.on(days), cfg)
    path = os.path.join(inputs.root, "mv_stream_overview")
    overview(inputs, cfg).write.mode("overwrite").parquet(path)
    out["mv_stream_overview"] = path
    batches = _read(inputs.spark, inputs.root, "_partial_batches", _batches(inputs.stored("stream_progress"), cfg))
    for name, (kind, build) in FRAMES.items():
        out[name] = os.path.join(inputs.root, name)
        reached = reached_days(batches, days, kind)
        if reached is None:
            rows = build(inputs.stored("stream_progress"), cfg).withColumn("event_date", F.to_date("timestamp"))
        else:
            rows = frame_rows(inputs, name, cfg, reached)
        _write_days(rows, out[name])
    return out
