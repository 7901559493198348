"""Listener callback cost and buffer bounds (no streaming query needed)."""

from __future__ import annotations

import json
import tempfile
import time
from types import SimpleNamespace

from vigil.config import MonitorConfig
from vigil.streaming.listener import ProgressCapture

DOC = json.dumps(
    {
        "id": "q1", "runId": "r1", "name": "Stream One", "timestamp": "2024-01-01T00:00:00.000Z", "batchId": 7,
        "batchDuration": 120, "numInputRows": 10, "inputRowsPerSecond": 1.5, "processedRowsPerSecond": 2.5,
        "durationMs": {"addBatch": 100}, "eventTime": {"max": "2024-01-01T00:00:00.000Z"},
        "stateOperators": [{"operatorName": "agg", "numRowsTotal": 5, "memoryUsedBytes": 1024}],
        "sources": [], "sink": {"description": "x", "numOutputRows": 10},
    }
)


def _event(i=0):
    return SimpleNamespace(progress=SimpleNamespace(json=DOC))


def callback_micros(cap: ProgressCapture, n: int = 20000) -> float:
    ev = _event()
    t = time.perf_counter()
    for _ in range(n):
        cap.onQueryProgress(ev)
    return (time.perf_counter() - t) / n * 1e6


def test_progress_callback_is_microseconds(spark):
    cap = ProgressCapture(spark, tempfile.mkdtemp(prefix="vigil-lu-"), MonitorConfig(), max_queued=10**6, background=False)
    us = callback_micros(cap)
    assert us < 100, us  # an append to a bounded buffer, no parsing, no Spark call


def test_full_buffer_is_written_and_loses_nothing(spark):
    out = tempfile.mkdtemp(prefix="vigil-lu-")
    cap = ProgressCapture(spark, out, MonitorConfig(), max_queued=10, background=False)
    for i in range(25):
        cap.onQueryProgress(_event(i))
    assert cap.flushed == 20 and cap.flush() == 5
    assert spark.read.parquet(out).count() == 25


def test_full_buffer_waits_while_writes_fail(spark):
    out = tempfile.mkdtemp(prefix="vigil-lu-")
    cap = ProgressCapture(spark, out, MonitorConfig(), max_queued=4, background=False)
    cap.bronze_dir = "/proc/no-such-dir/bronze"
    for i in range(6):
        cap.onQueryProgress(_event(i))
    assert cap.failed_flushes == 3
    cap.bronze_dir = out
    assert cap.flush() == 6 and spark.read.parquet(out).count() == 6


def test_background_flush_on_size(spark):
    out = tempfile.mkdtemp(prefix="vigil-lu-")
    cap = ProgressCapture(spark, out, MonitorConfig(), batch_size=5, flush_seconds=3600)
    try:
        for i in range(5):
            cap.onQueryProgress(_event(i))
        deadline = time.monotonic() + 30
        while cap.flushed < 5 and time.monotonic() < deadline:
            time.sleep(0.2)
        assert cap.flushed == 5
    finally:
        cap.stop()


def test_clean_stop_is_info_unless_include_clean(spark):
    from pyspark.sql import functions as F

    from vigil.operators import silver
    from vigil.sources.event_log import read_event_log

    term = SimpleNamespace(id="q9", runId="r9", exception=None, errorClassOnException=None)
    for include, level in ((False, "INFO"), (True, "ERROR")):
        out = tempfile.mkdtemp(prefix="vigil-lu-")
        cap = ProgressCapture(spark, out, MonitorConfig(), background=False, include_clean=include)
        cap.onQueryTerminated(term)
        cap.flush()
        log = read_event_log(spark, out)
        assert [r.level for r in log.collect()] == [level]
        assert silver.stream_errors(log, MonitorConfig()).count() == (1 if include else 0)
        assert log.filter(F.col("event_type") == "stream_terminated").count() == 1


def test_failed_flush_keeps_records(spark):
    out = tempfile.mkdtemp(prefix="vigil-lu-")
    cap = ProgressCapture(spark, out, MonitorConfig(), background=False)
    for i in range(3):
        cap.onQueryProgress(_event(i))
    cap.bronze_dir = "/proc/no-such-dir/bronze"  # unwritable: the write fails
    try:
        cap.flush()
        raise AssertionError("flush should fail")
    except AssertionError:
        raise
    except Exception:
        pass
    cap.bronze_dir = out
    assert cap.flush() == 3
    assert spark.read.parquet(out).count() == 3


def test_failed_stop_is_error_and_turns_stream_to_error(spark):
    from vigil.operators import gold, silver
    from vigil.sources.event_log import read_event_log

    out = tempfile.mkdtemp(prefix="vigil-lu-")
    cfg = MonitorConfig(as_of="2099-01-01 00:00:00", lookback_days=None)
    cap = ProgressCapture(spark, out, cfg, background=False)
    cap.onQueryStarted(SimpleNamespace(id="q1", name="Stream One"))
    cap.onQueryProgress(_event())
    time.sleep(0.01)
    cap.onQueryTerminated(SimpleNamespace(id="q1", runId="r1", exception="java.lang.RuntimeException: boom", errorClassOnException=None))
    cap.flush()
    log = read_event_log(spark, out)
    errs = silver.stream_errors(log, cfg).collect()
    assert len(errs) == 1 and errs[0].query_name == "stream_one" and errs[0].exception_message.endswith("boom")
    prog = silver.progress(log, cfg)
    ov = gold.stream_overview(prog, silver.stream_errors(log, cfg), silver.sla_latency_metrics(prog, cfg), cfg).collect()
    assert [r.stream_status for r in ov] == ["ERROR"]
