"""Job entry points: one run each, scheduled by the cluster's scheduler.

* ``pipeline``: bronze event log -> silver (streaming flows, availableNow,
  one checkpoint each) -> gold datasets from the stored silver.
* ``alerts``: the five detectors at a clock over stored silver, evaluated
  against the rules, routed, appended to ``alert_firings`` (by day).
* ``maintenance``: retention (partition drop), compaction and row counts for
  every table of a catalog database.

    python -m vigil.jobs pipeline --bronze DIR --root DIR [--environment prod]
    python -m vigil.jobs alerts --root DIR [--as-of "2024-01-31 00:00:00"]
    python -m vigil.jobs maintenance --database DB --as-of TS [--retention-days 90]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.operators import alerts, evaluate, maintain
from vigil.plans import datasets
from vigil.session import configure
from vigil.streaming import flows


def pipeline(spark: SparkSession, bronze_dir: str, root: str, cfg: MonitorConfig, days: list | None = None) -> dict[str, str]:
    """Silver by stream (incremental, exactly-once per checkpoint; includes
    the typed progress view), then gold from the stored silver: rebuilt
    whole, or, when ``days`` (the days the new bronze rows fall on) is
    given, refreshed only for those days."""
    out = flows.run_silver_flows(spark, bronze_dir, root, cfg)
    if days is None:
        out.update(datasets.materialize(spark, None, root, cfg, layers=("gold",)))
    else:
        out.update(datasets.refresh(spark, root, cfg, days))
    return out


def detector_evaluations(prog: DataFrame, errors: DataFrame, sla: DataFrame, cfg: MonitorConfig, as_of: str) -> DataFrame:
    """All five detectors at ``as_of`` with the default lookbacks, as
    (detector, entity, value, evaluated_at) rows."""
    c = cfg.with_(as_of=as_of)
    ev = evaluate.to_evaluations
    sp = alerts.duration_spike_candidates(prog, c)
    sp = sp.withColumn("_e", F.concat_ws("/", "query_name", F.col("batch_id").cast("string")))
    parts = [
        ev(alerts.sla_breach(sla, c), "alert_sla_breach", "query_name", "breach_count", as_of),
        ev(alerts.sustained_backpressure(prog, c, min_count=0), "alert_sustained_backpressure", "query_name", "backpressured_count", as_of),
        ev(sp, "alert_batch_duration_spike", "_e", "raw_spike_factor", as_of),
        ev(alerts.stream_terminated(errors, c), "alert_stream_terminated", "query_id", None, as_of, count=True),
        ev(alerts.state_growth(prog, c, pct=float("-inf")), "alert_state_memory_growth", "query_name", "growth_pct", as_of),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alerts_job(spark: SparkSession, root: str, cfg: MonitorConfig, as_of: str, rules=evaluate.RULES) -> DataFrame:
    """Evaluate and route at ``as_of`` (rules: tuples or a rule table);
    append fired alerts to ``root/alert_firings`` partitioned by day, with
    ``notified`` set by the rule's re-arm time (U7) against the last
    notification of the same (alert, entity) in earlier runs.  A re-run for
    the same clock replaces its own rows.  Returns the fired rows of this
    run."""
    prog = spark.read.parquet(os.path.join(root, "stream_progress"))
    # the rules count terminations per query, so the lookback prunes days and
    # no history is numbered
    errors = spark.read.parquet(os.path.join(root, "stream_errors"))
    sla = spark.read.parquet(os.path.join(root, "sla_latency_metrics"))
    evaluated = evaluate.evaluate(detector_evaluations(prog, errors, sla, cfg, as_of), rules)
    routed = evaluate.route(evaluated, evaluate.escalation_df(spark), cfg.environment)
    fired = routed.select("name", "entity", "value", "threshold", "severity", "channel", "message", "evaluated_at", "rearm_seconds")
    firings = os.path.join(root, "alert_firings")
    if _exists(spark, firings):
        # one row per (alert, entity): the last notification before this run
        last = (
            spark.read.parquet(firings)
            .filter(F.col("notified") & (F.col("evaluated_at") < F.to_timestamp(F.lit(as_of))))
            .groupBy("name", "entity")
            .agg(F.max("evaluated_at").alias("_last"))
        )
        fired = fired.join(last, ["name", "entity"], "left")
    else:
        fired = fired.withColumn("_last", F.lit(None).cast("timestamp"))
    notified = F.col("_last").isNull() | ((F.unix_seconds("evaluated_at") - F.unix_seconds("_last")) >= F.col("rearm_seconds"))
    out = fired.withColumn("notified", notified).drop("_last")
    # one partition per run: re-running the job for the same clock (after a
    # failure) replaces that run's rows instead of adding them again
    run_id = F.date_format(F.to_timestamp(F.lit(as_of)), "yyyyMMddHHmmss")
    (
        out.withColumn("event_date", F.to_date("evaluated_at"))
        .withColumn("run_id", run_id)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "run_id")
        .parquet(firings)
    )
    return spark.read.parquet(firings).filter(F.col("evaluated_at") == F.to_timestamp(F.lit(as_of)))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def maintenance(spark: SparkSession, database: str, as_of: str, retention_days: int = C.RETENTION_DAYS) -> DataFrame:
    """Retention and compaction of every table of ``database`` that is stored
    by day, and row counts of all."""
    names = maintain.list_tables(spark, database)
    for n in names:
        t = f"{database}.{n}"
        if maintain.PARTITION not in spark.table(t).columns:
            continue
        maintain.apply_retention(spark, t, as_of, retention_days)
        cols = maintain.CLUSTER_BY.get(n) or [c for c in ("event_type", "timestamp") if c in spark.table(t).columns]
        maintain.compact(spark, t, cols)
    return maintain.row_counts({n: spark.table(f"{database}.{n}") for n in names})


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vigil.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("--bronze", required=True)
    p.add_argument("--root", required=True)
    a = sub.add_parser("alerts")
    a.add_argument("--root", required=True)
    a.add_argument("--as-of", required=True)
    m = sub.add_parser("maintenance")
    m.add_argument("--database", required=True)
    m.add_argument("--as-of", required=True)
    m.add_argument("--retention-days", type=int, default=C.RETENTION_DAYS)
    for s in (p, a, m):
        s.add_argument("--environment", default="prod")
        s.add_argument("--sla-ms", type=int, default=C.SLA_LATENCY_CRITICAL_MS)
    args = ap.parse_args(argv)
    spark = configure(SparkSession.builder.getOrCreate())
    cfg = MonitorConfig(environment=args.environment, sla_ms=args.sla_ms)
    if args.job == "pipeline":
        print(pipeline(spark, args.bronze, args.root, cfg))
    elif args.job == "alerts":
        alerts_job(spark, args.root, cfg, args.as_of).show(truncate=False)
    else:
        maintenance(spark, args.database, args.as_of, args.retention_days).show()


if __name__ == "__main__":
    main()
