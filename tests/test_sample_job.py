"""The sample workload end to end: readings land, the ingest and the
windowed aggregation drain with availableNow in rounds, the listener
captures both queries, and the captured log feeds silver and gold."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import gold, silver
from vigil.sources.event_log import read_event_log
from vigil.streaming import sensors
from vigil.streaming.listener import ProgressCapture, wait_for_termination


def test_sample_job_with_capture(spark):
    base = tempfile.mkdtemp(prefix="vigil-sample-")
    landing, bronze, gold_dir, log = f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/log"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("_d", F.dayofmonth("ts"))
    cfg = MonitorConfig(as_of="2099-01-01 00:00:00", lookback_days=None)
    cap = ProgressCapture(spark, log, cfg, batch_size=5, flush_seconds=3)
    spark.streams.addListener(cap)
    rounds = [(1, 10), (11, 20), (21, 31)]
    ids = []
    try:
        for lo, hi in rounds:
            sensors.write_landing(sensors.readings_from_events(events.filter(F.col("_d").between(lo, hi))), landing)
            ids.append(str(sensors.run_ingest(spark, landing, bronze, f"{base}/_ckpt_ingest").id))
            ids.append(str(sensors.run_aggregation(spark, bronze, gold_dir, f"{base}/_ckpt_agg").id))
        # a query's termination event comes after all of its progress events
        assert all(wait_for_termination(cap, i, runs=ids.count(i)) for i in set(ids))
    finally:
        spark.streams.removeListener(cap)
        cap.stop()
    captured = read_event_log(spark, log)
    prog = silver.progress(captured, cfg)
    per_query = {r.query_name: sorted(r.ids) for r in prog.groupBy("query_name").agg(F.collect_list("batch_id").alias("ids")).collect()}
    assert set(per_query) == {"sensor_ingest", "sensor_aggregation"}
    for name, ids in per_query.items():
        assert ids == list(range(len(ids))), name  # every batch once, none missing
    assert prog.filter(F.col("query_name") == "sensor_ingest").agg(F.sum("num_input_rows")).first()[0] == events.count()
    # terminations of clean availableNow runs are INFO lifecycle rows, not errors
    assert silver.stream_errors(captured, cfg).count() == 0
    assert captured.filter(F.col("event_type") == "stream_terminated").count() == 2 * len(rounds)
    # the captured log answers the dashboard
    ov = {r.query_name: r for r in gold.stream_overview(prog, silver.stream_errors(captured, cfg), silver.sla_latency_metrics(prog, cfg), cfg).collect()}
    assert ov["sensor_ingest"].stream_status in ("ACTIVE", "INACTIVE")
    assert gold.throughput_trends(prog, cfg).agg(F.sum("total_input_rows")).first()[0] >= events.count()
    # the aggregation's event-time latency is measured from the readings
    sla = silver.sla_latency_metrics(prog.filter(F.col("query_name") == "sensor_aggregation"), cfg)
    assert sla.filter(F.col("event_time_max").isNotNull()).count() > 0
