"""Golden edge cases on hand-written progress logs (5-30 rows each)."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigil import schemas
from vigil.config import MonitorConfig
from vigil.functions.core import sanitize_name
from vigil.operators import alerts, evaluate, frames, gold, silver

T0 = datetime(2024, 3, 1, 12, 0, 0)
AS_OF = "2024-03-02 00:00:00"
CFG = MonitorConfig(as_of=AS_OF, lookback_days=7, sla_ms=60_000)


def iso(t: datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def progress_row(batch, *, qid="q1", name="Stream One", ts=None, inp=10.0, proc=20.0, duration=100, ops=None, event_max=None, quality=None, raw=None):
    ts = ts or T0 + timedelta(minutes=batch)
    if raw is not None:
        details = raw
    else:
        p = {"id": qid, "runId": "r1", "name": name, "timestamp": iso(ts), "batchId": batch, "batchDuration": duration,
             "numInputRows": 5, "inputRowsPerSecond": inp, "processedRowsPerSecond": proc}
        if ops is not None or ops == []:
            p["stateOperators"] = ops
        if event_max is not None:
            p["eventTime"] = {"max": iso(event_max), "min": iso(event_max)}
        if quality is not None:
            p["observedMetrics"] = quality
        details = json.dumps({"stream_progress": p})
    return (f"{qid}-{batch}", json.dumps({"batch_id": batch}), json.dumps({"flow_id": qid}), ts, "m", "METRICS", "stream_progress", "STABLE", details)


def bronze(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT_LOG_READ)


def prog(spark, rows, cfg=CFG):
    return silver.progress(bronze(spark, rows), cfg)


def test_processed_rate_zero_null_missing(spark):
    rows = [progress_row(0, inp=5.0, proc=0.0), progress_row(1, inp=5.0, proc=None), progress_row(2, raw=json.dumps({"stream_progress": {"id": "q1", "name": "x", "batchId": 2, "inputRowsPerSecond": 3.0}}))]
    out = {r.batch_id: r for r in gold.backpressure(prog(spark, rows), CFG).collect()}
    assert out[0].backpressure_ratio is None
    # a null/missing rate reads as 0.0 (the listener's default), so input > 0 flags
    assert out[1].backpressure_ratio is None and out[2].backpressure_ratio is None
    assert out[2].sustained_count == 3


def test_four_backpressured_batches(spark):
    rows = [progress_row(i, inp=50.0, proc=10.0) for i in range(4)]
    out = {r.batch_id: r.backpressure_status for r in gold.backpressure(prog(spark, rows), CFG).collect()}
    assert out == {0: "OK", 1: "OK", 2: "WARNING", 3: "WARNING"}
    cfg = CFG.with_(as_of="2024-03-01 12:30:00")
    assert alerts.sustained_backpressure(prog(spark, rows, cfg), cfg).count() == 0


def test_state_operator_folds(spark):
    rows = [
        progress_row(0, ops=None),
        progress_row(1, ops=[]),
        progress_row(2, ops=[{"memoryUsedBytes": 10, "numRowsTotal": None}, {"memoryUsedBytes": None, "numRowsTotal": 4}]),
    ]
    out = {r.batch_id: (r.state_memory_bytes, r.state_rows_total) for r in prog(spark, rows).collect()}
    assert out == {0: (None, None), 1: (0, 0), 2: (10, 4)}


def test_lag_skips_zero_memory_and_first_batch_growth(spark):
    rows = [progress_row(0, ops=[{"memoryUsedBytes": 100}]), progress_row(1, ops=[{"memoryUsedBytes": 0}]), progress_row(2, ops=[{"memoryUsedBytes": 150}])]
    out = {r.batch_id: r.memory_growth_pct for r in gold.state_store_health(prog(spark, rows), CFG).collect()}
    assert out == {0: 0.0, 2: 50.0}


def test_spike_threshold_exact_and_above(spark):
    base = [progress_row(i, duration=1000) for i in range(20)]
    exact = base + [progress_row(20, duration=3000)]
    above = base + [progress_row(20, duration=3004)]
    cfg = CFG.with_(as_of="2024-03-01 13:00:00")
    assert alerts.duration_spike(prog(spark, exact, cfg), cfg).count() == 0
    r = alerts.duration_spike(prog(spark, above, cfg), cfg).collect()
    assert len(r) == 1 and r[0].spike_factor == 3.0 and r[0].batch_id == 20
    # the very first batch has no history: never a spike
    assert alerts.duration_spike(prog(spark, [progress_row(0, duration=10**6)], cfg), cfg).count() == 0


def test_latency_threshold_null_and_negative(spark):
    rows = [
        progress_row(0, event_max=T0 - timedelta(seconds=60)),
        progress_row(1),
        progress_row(2, event_max=T0 + timedelta(minutes=2, seconds=5)),
    ]
    s = {r.batch_id: r for r in silver.sla_latency_metrics(prog(spark, rows), CFG).collect()}
    assert s[0].latency_ms == 60_000 and s[0].sla_breach_flag is False
    assert s[1].latency_ms is None and s[1].sla_breach_flag is False
    assert s[2].latency_ms == -5000
    lat = gold.latency_sla(silver.sla_latency_metrics(prog(spark, rows), CFG), CFG).agg(F.sum("batch_count")).first()[0]
    assert lat == 2


def test_malformed_documents_give_nulls(spark):
    rows = [
        progress_row(0, raw="{not json"),
        progress_row(1, raw=json.dumps({"stream_progress": {"id": "q1", "batchId": "abc", "timestamp": "yesterday"}})),
    ]
    p = prog(spark, rows).collect()
    assert [r.batch_id for r in p] == [None, None]
    assert all(r.trigger_ts is None for r in p)
    from vigil.operators import expect

    c = {r.expectation: r.failed_records for r in expect.violation_counts(silver.sla_latency_metrics(prog(spark, rows), CFG), expect.SLA_RULES).collect()}
    assert c["has_event_time"] == 2


@pytest.mark.parametrize(
    "raw,expected",
    [(None, "unnamed_stream"), ("   ", "unnamed_stream"), (" My Stream/1 ", "my_stream_1"), ("a.b-c_d", "a.b-c_d")],
)
def test_sanitize(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(sanitize_name("n")).first()[0] == expected


def test_renamed_stream_two_overview_rows(spark):
    rows = [progress_row(0, name="Old"), progress_row(1, name="New")]
    p = prog(spark, rows)
    errors = silver.stream_errors(bronze(spark, rows), CFG)
    ov = gold.stream_overview(p, errors, silver.sla_latency_metrics(p, CFG), CFG).collect()
    assert sorted(r.query_name for r in ov) == ["new", "old"] and {r.query_id for r in ov} == {"q1"}


def test_empty_observed_metrics_gives_no_quality_row(spark):
    rows = [progress_row(0, quality={}), progress_row(1, quality={"quality": {"duplicate_rate": 0.5}})]
    dq = silver.data_quality_metrics(prog(spark, rows), CFG).collect()
    assert [r.batch_id for r in dq] == [1]


def test_replayed_batch_deduplicated(spark):
    rows = [progress_row(0), progress_row(1)]
    b = bronze(spark, rows + rows)
    assert silver.dedupe_events(b).count() == 2


def test_batch_id_order_differs_from_time_order(spark):
    # batch 1 has the earlier timestamp; frames follow batch_id, growth alert follows time
    rows = [
        progress_row(0, ts=T0 + timedelta(minutes=5), inp=9.0, proc=1.0, ops=[{"memoryUsedBytes": 100}]),
        progress_row(1, ts=T0 + timedelta(minutes=1), inp=1.0, proc=9.0, ops=[{"memoryUsedBytes": 300}]),
    ]
    bp = {r.batch_id: r.sustained_count for r in gold.backpressure(prog(spark, rows), CFG).collect()}
    assert bp == {0: 1, 1: 1}
    cfg = CFG.with_(as_of="2024-03-01 12:10:00")
    g = alerts.state_growth(prog(spark, rows, cfg), cfg).collect()
    assert g == []  # by time: 300 -> 100, a shrink


def test_rearm_every_second_firing(spark):
    firings = spark.createDataFrame(
        [("a", "e1", T0 + timedelta(minutes=5 * i), 600) for i in range(6)], "name string, entity string, evaluated_at timestamp, rearm_seconds int"
    )
    out = sorted((r.evaluated_at, r.notified) for r in evaluate.rearm(firings).collect())
    assert [n for _, n in out] == [True, False, True, False, True, False]


def test_split_frames_equal_plain_window(spark):
    import random

    rnd = random.Random(7)
    rows = []
    for key in ("a", "b", "c"):
        ids = sorted(rnd.sample(range(0, 5000), 400))
        rows += [(key, i, rnd.randint(0, 1), rnd.randint(1, 100)) for i in ids]
    df = spark.createDataFrame(rows, "k string, o long, f int, v long")

    def build(w):
        return {"s5": F.sum("f").over(w.rowsBetween(-4, 0)), "a20": F.avg("v").over(w.rowsBetween(-20, -1)), "prev": F.lag("v").over(w)}

    plain = frames.rows_frame(df, ["k"], ["o"], 20, build, None)
    split = frames.rows_frame(df, ["k"], ["o"], 20, build, 23, F.floor(F.col("o") / 97))
    assert sorted(plain.collect()) == sorted(split.collect())
    mb_plain = frames.max_before(df, ["k"], "o", "v", "m")
    mb_split = frames.max_before(df, ["k"], "o", "v", "m", F.floor(F.col("o") / 97))
    assert sorted(mb_plain.collect()) == sorted(mb_split.collect())


def test_dashboard_ordering(spark):
    rows = [progress_row(i, qid=q, name=n) for q, n in (("q2", "B"), ("q1", "A")) for i in range(3)]
    bp = [(r.query_name, r.batch_id) for r in gold.ordered(gold.backpressure(prog(spark, rows), CFG), "backpressure").collect()]
    assert bp == [("a", 2), ("a", 1), ("a", 0), ("b", 2), ("b", 1), ("b", 0)]
    sh = [(r.query_name, r.batch_id) for r in gold.ordered(gold.state_store_health(prog(spark, [progress_row(i, ops=[{"memoryUsedBytes": 5}]) for i in (2, 0, 1)]), CFG), "state_store_health").collect()]
    assert sh == [("stream_one", 0), ("stream_one", 1), ("stream_one", 2)]


def test_rearm_bursts_split_exactly(spark):
    secs = [0, 300, 600, 900, 2000, 2300, 2900, 2950]
    firings = spark.createDataFrame(
        [("a", "e1", T0 + timedelta(seconds=s), 600) for s in secs], "name string, entity string, evaluated_at timestamp, rearm_seconds int"
    )
    expected = [True, False, True, False, True, False, True, False]
    for block in (None, 2):
        out = sorted((r.evaluated_at, r.notified) for r in evaluate.rearm(firings, block_rows=block, chunk_seconds=1000).collect())
        assert [n for _, n in out] == expected, block


def test_latency_precision_seconds(spark):
    rows = [progress_row(0, event_max=T0 - timedelta(seconds=61, milliseconds=700))]
    ms = silver.sla_latency_metrics(prog(spark, rows), CFG).first().latency_ms
    sec = silver.sla_latency_metrics(prog(spark, rows), CFG.with_(latency_precision="seconds")).first().latency_ms
    assert ms == 61_700 and sec == 62_000  # unix_timestamp floors both ends: 12:00:00 - 11:58:58


def test_backtest_alert_uses_rule_schedule(spark):
    from vigil.plans.context import Context

    c = Context(spark, "/root/testdata/sf0.001", MonitorConfig(sla_ms=1_800_000, as_of="2024-01-31 00:00:00", lookback_days=None))
    out = evaluate.backtest_alert("streaming_sla_breach", c.prog, c.errors, c.sla, "2024-01-01 00:00:00", "2024-01-31 00:00:00")
    rows = out.select("name", "evaluated_at", "fired").collect()
    assert rows and {r.name for r in rows} == {"streaming_sla_breach"} and all(r.fired for r in rows)
    assert all(r.evaluated_at.minute % 5 == 0 and r.evaluated_at.second == 0 for r in rows)  # every 300 s
    t = evaluate.backtest_alert("streaming_stream_terminated", c.prog, c.errors, c.sla, "2024-01-01 00:00:00", "2024-01-31 00:00:00")
    assert t.filter(~F.col("fired")).count() == 0 and t.count() > 0


@pytest.mark.parametrize(
    "op,expected",
    [("GREATER_THAN", [False, False, True]), ("GREATER_THAN_OR_EQUAL", [False, True, True]), ("LESS_THAN", [True, False, False]),
     ("LESS_THAN_OR_EQUAL", [True, True, False]), ("EQUAL", [False, True, False]), ("NOT_EQUAL", [True, False, True])],
)
def test_rule_operators(spark, op, expected):
    evals = spark.createDataFrame([("d", "e1", 1.0), ("d", "e2", 2.0), ("d", "e3", 3.0)], "query_name string, entity string, value double")
    rules = [("r", "d", 60, op, None, "value", 2.0, "warning", "slack", 60, "x")]
    out = sorted((r.entity, r.fired) for r in evaluate.evaluate(evals, rules).collect())
    assert [f for _, f in out] == expected


def test_round_half_up_of_large_values(spark):
    from vigil.functions.core import round_half_up

    df = spark.createDataFrame([(1e13,), (2.675,), (-1.005,), (float("nan"),), (None,), (1e300,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:3] == [1e13, 2.68, -1.01] and got[3] != got[3] and got[4] is None and got[5] == 1e300


def test_many_rules_join_and_unknown_operator(spark):
    import pytest

    from vigil import schemas
    from vigil.operators import evaluate

    first = dict(zip(evaluate.RULE_FIELDS, evaluate.RULES[0]))
    rows = [tuple({**first, "name": f"r{i}", "query_name": f"d{i}", "op": "GREATER_THAN", "threshold": 1.0}[f] for f in evaluate.RULE_FIELDS) for i in range(10_001)]
    rules = spark.createDataFrame(rows, schemas.ALERT_RULE)
    ev = spark.createDataFrame([("d10000", "a", 2.0), ("d3", "b", 0.5), ("none", "c", 9.0)], "query_name string, entity string, value double")
    got = sorted((r.name, r.fired) for r in evaluate.evaluate(ev, rules).collect())
    assert got == [("r10000", True), ("r3", False)]
    bad = tuple({**first, "query_name": "d3", "op": "BIGGER"}[f] for f in evaluate.RULE_FIELDS)
    with pytest.raises(Exception, match="unknown rule operator"):
        evaluate.evaluate(ev, [bad]).collect()


def test_streams_have_no_clock_filter(spark, tmp_path):
    from pyspark.sql import functions as F

    from vigil.config import MonitorConfig
    from vigil.operators import gold

    spark.range(5).select(F.lit("prod").alias("environment"), (F.current_timestamp() + F.expr("INTERVAL 2 HOURS")).alias("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("environment string, timestamp timestamp").parquet(str(tmp_path / "in"))
    cfg = MonitorConfig(lookback_days=None, as_of=None)
    q = gold.scoped(stream, cfg).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert gold.scoped(spark.read.parquet(str(tmp_path / "in")), cfg).count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    import pytest

    from vigil import session

    class Sc:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Sc()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Fake())
