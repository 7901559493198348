"""Streaming behaviour: listener capture, lifecycle rows, observed
expectations on a stream, rate demo."""

from __future__ import annotations

import json
import tempfile
import time

from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import expect, silver
from vigil.sources.event_log import read_event_log
from vigil.streaming import flows
from vigil.streaming.listener import ProgressCapture, wait_for_termination


def test_rate_demo(spark):
    flows.rate_demo(spark, "vigil_rate_demo", rows_per_second=100, seconds=2.0)
    assert spark.table("vigil_rate_demo").count() > 0


def test_listener_captures_each_batch_once_and_clean_stop_is_info(spark):
    src = tempfile.mkdtemp(prefix="vigil-src-")
    cap_dir = tempfile.mkdtemp(prefix="vigil-cap-")
    ckpt = tempfile.mkdtemp(prefix="vigil-ckpt-")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for t in ("click", "view", "error"):
        events.filter(F.col("event_type") == t).coalesce(1).write.mode("append").parquet(src)
    cap = ProgressCapture(spark, cap_dir, MonitorConfig(), batch_size=2, flush_seconds=1)
    spark.streams.addListener(cap)
    try:
        q = (
            spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(src)
            .writeStream.format("noop").queryName("vigil capture test").option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start()
        )
        q.awaitTermination()
        assert wait_for_termination(cap, str(q.id))
    finally:
        spark.streams.removeListener(cap)
        cap.stop()
    log = read_event_log(spark, cap_dir)
    p = silver.progress(log, MonitorConfig()).filter(F.col("num_input_rows") > 0)
    ids = [r.batch_id for r in p.select("batch_id").collect()]
    assert sorted(ids) == list(range(len(ids))) and len(ids) == 3
    assert {r.query_name for r in p.select("query_name").collect()} == {"vigil_capture_test"}
    life = log.filter(F.col("event_type") == "stream_terminated").collect()
    assert len(life) == 1 and life[0].level == "INFO"
    assert json.loads(life[0].origin)["flow_name"] == "vigil_capture_test"
    assert silver.stream_errors(log, MonitorConfig()).count() == 0


def test_observed_expectations_on_stream(spark):
    src = tempfile.mkdtemp(prefix="vigil-obs-")
    ckpt = tempfile.mkdtemp(prefix="vigil-obs-ckpt-")
    spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string").coalesce(1).write.parquet(src + "/p")
    df = spark.readStream.schema("a int, b string").parquet(src + "/p")
    obs_df, obs = expect.expect(df, [("b_present", "b IS NOT NULL")], name="vigil_obs")
    seen = []

    def sink(batch, batch_id):
        seen.append(batch.count())

    q = obs_df.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    time.sleep(0.5)
    metrics = q.lastProgress["observedMetrics"]["vigil_obs"]
    assert metrics["total_records"] == 3 and metrics["b_present"] == 1


def test_observed_quality_reaches_silver_through_capture(spark):
    from vigil.operators import quality

    src = tempfile.mkdtemp(prefix="vigil-q-")
    cap_dir = tempfile.mkdtemp(prefix="vigil-q-cap-")
    ckpt = tempfile.mkdtemp(prefix="vigil-q-ckpt-")
    spark.createDataFrame([(1, 5.0), (1, None), (2, 7.0), (3, -1.0)], "k int, v double").coalesce(1).write.parquet(src + "/p")
    df = spark.readStream.schema("k int, v double").parquet(src + "/p")
    observed = quality.observe_quality(df, "k", [("v_present", "v IS NOT NULL"), ("v_positive", "v > 0")])
    cap = ProgressCapture(spark, cap_dir, MonitorConfig(), background=False)
    spark.streams.addListener(cap)
    try:
        q = observed.writeStream.format("noop").queryName("q obs").option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        assert wait_for_termination(cap, str(q.id))
    finally:
        spark.streams.removeListener(cap)
        cap.stop()
    dq = silver.data_quality_metrics(silver.progress(read_event_log(spark, cap_dir), MonitorConfig()), MonitorConfig()).collect()
    assert len(dq) >= 1
    row = [r for r in dq if r.dropped_record_count][0]
    assert row.query_name == "q_obs" and row.dropped_record_count == 2 and abs(row.duplicate_rate - 0.25) < 1e-9
    om = {(r.observation, r.metric): r.value for r in silver.observed_metrics(read_event_log(spark, cap_dir), MonitorConfig()).collect() if r.value is not None}
    assert om[("quality", "dropped_record_count")] == 2.0 and abs(om[("quality", "duplicate_rate")] - 0.25) < 1e-9


def test_quality_callback_fills_quality(spark):
    src = tempfile.mkdtemp(prefix="vigil-cb-")
    cap_dir = tempfile.mkdtemp(prefix="vigil-cb-cap-")
    ckpt = tempfile.mkdtemp(prefix="vigil-cb-ckpt-")
    spark.range(10).coalesce(1).write.parquet(src + "/p")
    cap = ProgressCapture(spark, cap_dir, MonitorConfig(), background=False)
    cap.register_quality_callback(lambda qid, bid, p: {"dropped_record_count": int(p["numInputRows"]), "duplicate_rate": 0.0})
    cap.register_quality_callback(lambda qid, bid, p: 1 / 0)
    spark.streams.addListener(cap)
    try:
        q = spark.readStream.schema("id long").parquet(src + "/p").writeStream.format("noop").option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
        assert wait_for_termination(cap, str(q.id))
    finally:
        spark.streams.removeListener(cap)
        cap.stop()
    dq = silver.data_quality_metrics(silver.progress(read_event_log(spark, cap_dir), MonitorConfig()), MonitorConfig()).collect()
    assert sorted(r.dropped_record_count for r in dq)[-1] == 10


def test_all_silver_flows_equal_batch_silver(spark):
    from vigil.plans.context import Context
    from vigil.sources.event_log import append_event_log

    c = Context(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="vigil-flows-")
    append_event_log(c.bronze, f"{root}/bronze")
    out = flows.run_silver_flows(spark, f"{root}/bronze", f"{root}/silver", c.cfg)
    batch = {"streaming_metrics": c.metrics, "stream_progress": c.prog, "stream_errors": c.errors_raw, "sla_latency_metrics": c.sla, "data_quality_metrics": c.dq}
    for t, path in out.items():
        assert spark.read.parquet(path).count() == batch[t].count(), t


def test_continuous_trigger_flow(spark):
    from vigil.plans.context import Context
    from vigil.sources.event_log import append_event_log

    c = Context(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="vigil-cont-")
    append_event_log(c.bronze, f"{root}/bronze")
    q = flows.run_silver_flow(spark, f"{root}/bronze", f"{root}/errors", f"{root}/_ckpt", "stream_errors", c.cfg, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(f"{root}/errors").count() == c.errors_raw.count()


def test_failed_batch_replays_without_duplicates(spark):
    """A micro-batch that fails after writing is replayed from the checkpoint
    on restart; the per-batch overwrite keeps the output exact."""
    from vigil.streaming import sensors

    base = tempfile.mkdtemp(prefix="vigil-replay-")
    landing, out, ckpt = f"{base}/landing", f"{base}/quality", f"{base}/_ckpt"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for t in ("click", "view", "error"):
        sensors.write_landing(sensors.readings_from_events(events.filter(F.col("event_type") == t)).coalesce(1), landing)
    state = {"failed": False}

    def sink(df, batch_id):
        flows.batch_quality(df, batch_id).drop("batch_id").write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("executor lost after the write")

    def run():
        src = sensors.bronze_stream(spark, landing, max_files_per_trigger=1)
        q = src.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    try:
        run()
    except Exception:
        pass
    assert state["failed"]
    run()  # restart from the same checkpoint
    got = spark.read.parquet(out).groupBy().sum("record_count").first()[0]
    assert got == events.filter(F.col("event_type").isin("click", "view", "error")).count()
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3


def test_replayed_bronze_append_is_deduplicated_in_stream(spark):
    from vigil.plans.context import Context
    from vigil.sources.event_log import append_event_log

    c = Context(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="vigil-dedupe-")
    day = F.to_date("timestamp")
    first = c.bronze.filter(day < "2024-01-16")
    append_event_log(first, f"{root}/bronze")
    flows.run_silver_flow(spark, f"{root}/bronze", f"{root}/errors", f"{root}/_ckpt", "stream_errors", c.cfg, dedupe_within="1 hour")
    append_event_log(first.filter(day >= "2024-01-15"), f"{root}/bronze")  # a replayed flush of the last day
    append_event_log(c.bronze.filter(day >= "2024-01-16"), f"{root}/bronze")
    flows.run_silver_flow(spark, f"{root}/bronze", f"{root}/errors", f"{root}/_ckpt", "stream_errors", c.cfg, dedupe_within="1 hour")
    out = spark.read.parquet(f"{root}/errors")
    assert out.count() == c.errors_raw.count()


def test_silver_flow_into_catalog_table(spark):
    from vigil.operators import maintain
    from vigil.plans.context import Context
    from vigil.sources.event_log import append_event_log

    c = Context(spark, "/root/testdata/sf0.001")
    root = tempfile.mkdtemp(prefix="vigil-totable-")
    append_event_log(c.bronze, f"{root}/bronze")
    maintain.create_monitoring_tables(spark, "vigil_stream_db", f"{root}/catalog")
    flows.run_silver_flow(spark, f"{root}/bronze", None, f"{root}/_ckpt", "stream_errors", c.cfg, to_table="vigil_stream_db.stream_errors")
    assert spark.table("vigil_stream_db.stream_errors").count() == c.errors_raw.count()


def test_out_of_order_landing_drops_late_rows_only(spark):
    """Readings land out of event-time order: rows behind the watermark are
    dropped, so each emitted window has at most the rows of the batch
    aggregate and no window appears that the batch does not have."""
    from vigil import schemas
    from vigil.streaming import sensors

    base = tempfile.mkdtemp(prefix="vigil-late-")
    landing, bronze, gold = f"{base}/landing", f"{base}/bronze", f"{base}/gold"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    readings = sensors.readings_from_events(ev)
    # day slices in a shuffled order: later days first, then earlier ones
    for lo, hi in ((21, 31), (1, 10), (11, 20)):
        sensors.write_landing(readings.filter(F.dayofmonth(F.to_timestamp("event_time")).between(lo, hi)), landing)
        sensors.run_ingest(spark, landing, bronze, f"{base}/_ci")
        sensors.run_aggregation(spark, bronze, gold, f"{base}/_ca")
    stream = spark.read.schema(schemas.SENSOR_GOLD).parquet(gold)
    b = spark.read.schema(schemas.SENSOR_BRONZE).parquet(bronze)
    batch = sensors.window_aggregate(b).select("window_start", "region", F.col("record_count").alias("full"))
    j = stream.join(batch, ["window_start", "region"], "left")
    assert j.filter(F.col("full").isNull()).count() == 0
    assert j.filter(F.col("record_count") > F.col("full")).count() == 0
    assert stream.agg(F.sum("record_count")).first()[0] < batch.agg(F.sum("full")).first()[0]
