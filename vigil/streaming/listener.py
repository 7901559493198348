"""Capture of live streaming queries.

``ProgressCapture`` is a ``StreamingQueryListener``.  Its callbacks only
append the raw progress JSON (or a termination note) to a bounded buffer,
so the listener bus is never blocked.  ``flush`` turns the buffered
documents into event-log rows with Spark expressions (same code as the
silver layer) and appends them to the bronze folder; a background thread
flushes on size (50) or age (10 s), and ``stop`` drains what is left.
A callback that finds the buffer at its bound writes it; a failed write puts
its records back into the buffer.  No record is dropped.
"""

from __future__ import annotations

import collections
import json
import threading
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.functions.core import iso_timestamp, sanitize_name
from vigil.sources.event_log import append_event_log

RAW = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("noted_at", T.TimestampType()),
    ]
)
_HEAD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "runId", "name", "timestamp", "batchId")])
_TERM = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "runId", "name", "exception", "error_class")])


class ProgressCapture(StreamingQueryListener):
    def __init__(
        self,
        spark: SparkSession,
        bronze_dir: str,
        cfg: MonitorConfig = MonitorConfig(),
        batch_size: int = C.WRITER_BATCH_SIZE,
        flush_seconds: float = C.WRITER_FLUSH_SECONDS,
        max_queued: int = C.WRITER_QUEUE_MAX,
        background: bool = True,
        include_clean: bool = False,
    ):
        """``include_clean=True`` writes every termination, clean stops
        included, as an ERROR row (the reference listener's behaviour, which
        turns each finished availableNow run into an error); by default a
        clean stop is an INFO lifecycle row."""
        super().__init__()
        self.include_clean = include_clean
        self.spark = spark
        self.bronze_dir = bronze_dir
        self.cfg = cfg
        self.batch_size = batch_size
        self.flush_seconds = flush_seconds
        self.max_queued = max_queued
        self.flushed = 0
        self.failed_flushes = 0
        self.terminated: set[str] = set()
        self.terminations: dict[str, int] = {}
        self._buf: collections.deque = collections.deque()
        self._lock = threading.Lock()
        self._stop = threading.Event()
        self._last_flush = time.monotonic()
        self._callbacks: list = []
        self._names: dict[str, str] = {}
        self._thread = threading.Thread(target=self._run, daemon=True) if background else None
        if self._thread:
            self._thread.start()

    # -- listener callbacks: append only ---------------------------------
    def _put(self, kind: str, payload: str) -> None:
        with self._lock:
            self._buf.append((kind, payload, datetime.now(timezone.utc).replace(tzinfo=None)))
            full = len(self._buf) >= self.max_queued
        if full:
            # the writer is behind: this callback writes, so that the buffer
            # stays bounded and no record is lost; if the write fails the
            # records wait in the buffer for the next one
            try:
                self.flush()
            except Exception:
                self.failed_flushes += 1

    def onQueryStarted(self, event) -> None:
        # remembered so that the termination row carries the stream's name
        if event.name:
            self._names[str(event.id)] = event.name

    def register_quality_callback(self, callback) -> None:
        """``callback(query_id, batch_id, progress: dict) -> dict | None``.
        A returned dict is stored as ``observedMetrics.quality`` of the
        captured document (unless the query already observed one); None is
        skipped, exceptions are swallowed.  Callbacks run on the listener
        thread and must be cheap; measure data in ``foreachBatch`` or with
        ``observe`` instead."""
        self._callbacks.append(callback)

    def onQueryProgress(self, event) -> None:
        raw = event.progress.json
        raw = raw() if callable(raw) else raw
        if self._callbacks:
            raw = self._with_callbacks(raw)
        self._put("progress", raw)

    def _with_callbacks(self, raw: str) -> str:
        try:
            doc = json.loads(raw)
        except ValueError:
            return raw
        om = doc.get("observedMetrics") or {}
        for cb in self._callbacks:
            try:
                res = cb(doc.get("id"), doc.get("batchId"), doc)
            except Exception:  # a failing callback never stops capture
                continue
            if isinstance(res, dict) and "quality" not in om:
                om["quality"] = res
        doc["observedMetrics"] = om
        return json.dumps(doc)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        exc = getattr(event, "exception", None)
        doc = {
            "id": str(event.id),
            "runId": str(event.runId),
            "name": self._names.get(str(event.id)),
            "exception": None if exc is None else str(exc),
            "error_class": getattr(event, "errorClassOnException", None),
        }
        self._put("terminated", json.dumps(doc))
        self.terminations[str(event.id)] = self.terminations.get(str(event.id), 0) + 1
        self.terminated.add(str(event.id))

    # -- writer ------------------------------------------------------------
    def _run(self) -> None:
        while not self._stop.wait(0.5):
            with self._lock:
                n = len(self._buf)
            if n >= self.batch_size or (n and time.monotonic() - self._last_flush >= self.flush_seconds):
                try:
                    self.flush()
                except Exception:  # records were put back; retried on the next tick
                    self.failed_flushes += 1

    def flush(self) -> int:
        """Append buffered records to bronze; returns the number written."""
        with self._lock:
            rows = list(self._buf)
            self._buf.clear()
            self._last_flush = time.monotonic()
        if not rows:
            return 0
        # at most ``max_queued`` rows: one partition, so one file per day per
        # flush instead of one per default-parallelism slice
        try:
            df = self.spark.createDataFrame(rows, RAW).coalesce(1)
            append_event_log(_to_event_log(df, self.cfg, self.include_clean), self.bronze_dir)
        except Exception:
            # a failed write loses nothing: the records go back to the front of
            # the buffer, over its bound if need be
            with self._lock:
                self._buf.extendleft(reversed(rows))
            raise
        self.flushed += len(rows)
        return len(rows)

    def stop(self) -> None:
        """Stop the background thread and drain the buffer."""
        self._stop.set()
        if self._thread:
            self._thread.join(timeout=30)
        self.flush()


def _to_event_log(raw, cfg: MonitorConfig, include_clean: bool = False):
    """Raw captured documents -> bronze event-log rows (Spark side)."""
    h = F.from_json("payload", _HEAD)
    t = F.from_json("payload", _TERM)
    is_p = F.col("kind") == "progress"
    qid = F.when(is_p, h["id"]).otherwise(t["id"])
    run = F.when(is_p, h["runId"]).otherwise(t["runId"])
    name = sanitize_name(F.when(is_p, h["name"]).otherwise(t["name"]))
    batch = F.when(is_p, h["batchId"].try_cast("bigint"))
    ts = F.when(is_p, F.coalesce(iso_timestamp(h["timestamp"]), F.col("noted_at"))).otherwise(F.col("noted_at"))
    failed = t["exception"].isNotNull()
    as_error = failed | F.lit(include_clean)
    error = F.to_json(
        F.struct(
            F.struct(
                F.lit(None).cast("bigint").alias("batch_id"),
                F.when(failed, F.lit("StreamingQueryException")).alias("exception_type"),
                t["exception"].alias("message"),
                F.coalesce(t["error_class"], F.when(failed, F.lit("UNKNOWN")), F.lit("STOPPED")).alias("termination_reason"),
                F.lit(None).cast("string").alias("stack_trace"),
            ).alias("error")
        )
    )
    return raw.select(
        F.sha2(F.concat_ws("|", F.col("kind"), run, F.coalesce(batch.cast("string"), F.col("noted_at").cast("string"))), 256).alias("id"),
        F.to_json(F.struct(batch.alias("batch_id"))).alias("sequence"),
        F.to_json(
            F.struct(
                F.lit(cfg.workspace_id).cast("string").alias("workspace_id"),
                F.lit(None).cast("string").alias("job_id"),
                name.alias("flow_name"),
                qid.alias("flow_id"),
            )
        ).alias("origin"),
        ts.alias("timestamp"),
        F.when(is_p, F.format_string(C.PROGRESS_MESSAGE, name, batch))
        .otherwise(F.format_string("Stream %s terminated.", qid))
        .alias("message"),
        F.when(is_p, "METRICS").when(as_error, "ERROR").otherwise("INFO").alias("level"),
        F.when(is_p, "stream_progress").otherwise("stream_terminated").alias("event_type"),
        F.lit("STABLE").alias("maturity_level"),
        F.when(is_p, F.concat(F.lit('{"stream_progress":'), F.col("payload"), F.lit("}"))).otherwise(error).alias("details"),
    )


def wait_for_termination(capture: ProgressCapture, query_id: str, timeout: float = 60.0, runs: int = 1) -> bool:
    """Listener events arrive asynchronously; wait until ``runs``
    terminations of ``query_id`` have been seen (so every progress event
    before them is in)."""
    end = time.monotonic() + timeout
    while time.monotonic() < end:
        if capture.terminations.get(query_id, 0) >= runs:
            return True
        time.sleep(0.1)
    return False


__all__ = ["ProgressCapture", "wait_for_termination"]
