"""Job entry points end to end on the smallest data set."""

from __future__ import annotations

import os
import tempfile

from sf_paths import SF0001
from pyspark.sql import functions as F

from vigil import jobs
from vigil.operators import maintain
from vigil.plans.context import BASE, Context
from vigil.sources.event_log import append_event_log


def test_pipeline_then_alerts_then_maintenance(spark):
    c = Context(spark, SF0001)
    root = tempfile.mkdtemp(prefix="vigil-jobs-")
    append_event_log(c.bronze, f"{root}/bronze")
    out = jobs.pipeline(spark, f"{root}/bronze", f"{root}/lake", BASE)
    for name in ("streaming_metrics", "stream_errors", "sla_latency_metrics", "data_quality_metrics", "stream_progress", "mv_stream_overview", "mv_backpressure"):
        assert os.path.exists(out[name]), name
    assert spark.read.parquet(out["mv_backpressure"]).count() == c.prog.filter(F.col("timestamp") >= "2024-01-24").count()
    fired = jobs.alerts_job(spark, f"{root}/lake", BASE.with_(sla_ms=1_800_000), "2024-01-31 00:00:00")
    names = {r.name for r in fired.collect()}
    assert names <= {"streaming_sla_breach", "streaming_sustained_backpressure", "streaming_batch_duration_spike", "streaming_stream_terminated", "streaming_state_memory_growth"}
    assert fired.filter(F.col("channel").isNull()).count() == 0
    db = "vigil_jobs_db"
    maintain.create_monitoring_tables(spark, db, f"{root}/catalog")
    maintain.append(c.bronze, f"{db}.raw_events")
    counts = {r.table_name: r.row_count for r in jobs.maintenance(spark, db, "2024-01-31 00:00:00", 20).collect()}
    assert counts["raw_events"] == c.bronze.filter(F.to_date("timestamp") >= "2024-01-11").count()
    # the same over tables declared on the pipeline's own folders
    spark.sql("CREATE DATABASE IF NOT EXISTS vigil_lake_db")
    for t in ("stream_errors", "stream_progress", "mv_stream_overview"):
        spark.catalog.createTable(f"vigil_lake_db.{t}", path=out[t], source="parquet")
    rows = spark.read.parquet(out["stream_errors"]).filter(F.col("event_date") >= "2024-01-11").count()
    for _ in range(2):
        counts = {r.table_name: r.row_count for r in jobs.maintenance(spark, "vigil_lake_db", "2024-01-31 00:00:00", 20).collect()}
        assert counts["stream_errors"] == rows == spark.read.parquet(out["stream_errors"]).count() and counts["mv_stream_overview"] == 5


def test_batches_and_merges_are_idempotent(spark):
    root = tempfile.mkdtemp(prefix="vigil-batch-")
    db = "vigil_swap_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    schema = spark.range(1).select(F.col("id").alias("x")).schema
    maintain.create_table(spark, f"{db}.t", schema, f"{root}/t")
    df = spark.range(100).select(F.col("id").alias("x"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("event_date"))
    for batch in (0, 1, 1, 0, 2):  # batches 0 and 1 are repeated
        maintain.insert_batch(df.repartition(3), f"{db}.t", maintain.stream_batch("src", batch))
    t = lambda: spark.table(f"{db}.t")
    assert t().count() == 300
    # the newest batch of the stream stays as it is, the others become one
    assert maintain.compact(spark, f"{db}.t", ["x"]) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert t().count() == 300 and t().agg(F.sum("x")).first()[0] == 3 * 4950
    assert {r[0].split("-")[0] for r in t().select("write_batch").distinct().collect()} == {"src", "merge"}
    assert maintain.compact(spark, f"{db}.t", ["x"]) == []
    # a restart writes its last batch again
    maintain.insert_batch(df, f"{db}.t", maintain.stream_batch("src", 2))
    assert t().count() == 300


def test_cut_off_merges_lose_and_repeat_nothing(spark):
    root = tempfile.mkdtemp(prefix="vigil-cut-")
    spark.sql("CREATE DATABASE IF NOT EXISTS vigil_cut_db")
    name, loc = "vigil_cut_db.t", f"{root}/t"
    maintain.create_table(spark, name, spark.range(1).select(F.col("id").alias("x")).schema, loc)
    df = spark.range(60).select(F.col("id").alias("x"), F.lit("2024-01-01").cast("date").alias("event_date"))
    for b in ("load-a", "load-b"):
        maintain.insert_batch(df, name, b)
    log = spark.createDataFrame([("merge-1", "2024-01-01", "load-a"), ("merge-1", "2024-01-01", "load-b")], "run string, day string, batch string")
    # cut off before the rewrite: nothing changes
    log.write.parquet(f"{loc}/_merges/merge-1")
    maintain._finish_merges(spark, name, loc)
    assert spark.table(name).count() == 120 and not os.path.exists(f"{loc}/_merges")
    # cut off after the rewrite: the next run puts it in place
    log.write.parquet(f"{loc}/_merges/merge-1")
    maintain.write_batch(spark.table(name).drop("write_batch").coalesce(1), loc, "merge-1")
    assert spark.table(name).count() == 120  # not yet registered
    maintain._finish_merges(spark, name, loc)
    assert spark.table(name).count() == 120 and [r[0] for r in spark.table(name).select("write_batch").distinct().collect()] == ["merge-1"]
    assert sorted(os.listdir(f"{loc}/event_date=2024-01-01")) == ["write_batch=merge-1"]


def test_cluster_key(spark):
    import datetime as dt

    rows = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"), F.lit(None).cast("string").alias("c"))
    keys = rows.withColumn("z", maintain.cluster_key(rows, ["a", "b"], 2)).groupBy("z").agg(F.count("*").alias("n"), F.max("a") - F.min("a"), F.max("b") - F.min("b")).collect()
    assert len(keys) == 16 and all(tuple(k[1:]) == (256, 15, 15) for k in keys)  # 16 squares
    assert rows.select(maintain.cluster_key(rows, ["c"])).distinct().collect() == [(0,)]
    assert rows.limit(0).select(maintain.cluster_key(rows.limit(0), ["a"])).count() == 0
    stamped = rows.withColumn("t", F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.col("a")))
    assert stamped.select(maintain.cluster_key(stamped, ["t", "a"])).distinct().count() > 16


def test_alerts_job_rearm_across_runs(spark):
    c = Context(spark, SF0001)
    root = tempfile.mkdtemp(prefix="vigil-rearm-")
    append_event_log(c.bronze, f"{root}/bronze")
    cfg = BASE.with_(sla_ms=60_000, lookback_days=None)
    jobs.pipeline(spark, f"{root}/bronze", f"{root}/lake", cfg)
    sla = F.col("name") == "streaming_sla_breach"
    first = jobs.alerts_job(spark, f"{root}/lake", cfg, "2024-01-30 12:00:00").filter(sla).collect()
    second = jobs.alerts_job(spark, f"{root}/lake", cfg, "2024-01-30 12:05:00").filter(sla).collect()
    third = jobs.alerts_job(spark, f"{root}/lake", cfg, "2024-01-30 12:10:00").filter(sla).collect()
    again = jobs.alerts_job(spark, f"{root}/lake", cfg, "2024-01-30 12:10:00").filter(sla).collect()
    assert sorted((r.entity, r.notified) for r in again) == sorted((r.entity, r.notified) for r in third)  # re-run replaces
    assert first and all(r.notified for r in first)
    assert second and not any(r.notified for r in second)  # 300 s < 600 s re-arm
    assert {r.entity for r in third if r.notified} == {r.entity for r in first} & {r.entity for r in third}


def test_list_tables_ignores_temp_views(spark):
    root = tempfile.mkdtemp(prefix="vigil-lt-")
    maintain.create_monitoring_tables(spark, "vigil_lt_db", f"{root}/catalog")
    spark.range(1).createOrReplaceTempView("stream_progress")
    names = maintain.list_tables(spark, "vigil_lt_db")
    assert "stream_progress" not in names and "raw_events" in names
