"""Detectors on live streams whose rows arrive out of order.

A row is held in its stream's state until the watermark has passed its
timestamp, so nothing older can still arrive; the rows that fall due are
evaluated in order and dropped from the state.  An event-time timer set to the
oldest held row releases it when the stream itself falls silent.  Per stream
the state holds the rows of one watermark delay and what the detector carries
(20 durations, or one time): it does not grow with the history.

Rows later than the watermark are dropped by Spark, as in every watermarked
stream.  Batch ids grow with the batch timestamps of a stream (one checkpoint
numbers its batches in trigger order), so order by time and by batch id agree
between rows due at different watermarks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.functions.core import round_half_up


def _array(name: str, of: T.DataType) -> T.StructField:
    return T.StructField(name, T.ArrayType(of))


SPIKE_STATE = T.StructType(
    [_array("ts", T.LongType()), _array("batch_id", T.LongType()), _array("duration", T.LongType()), _array("name", T.StringType()), _array("ring", T.LongType())]
)
SPIKE_ROWS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("batch_duration_ms", T.LongType()),
        T.StructField("_avg", T.DoubleType()),
    ]
)
STATUS_STATE = T.StructType(
    [
        _array("ts", T.LongType()),
        _array("name", T.StringType()),
        T.StructField("last_ts", T.LongType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("inactive", T.BooleanType()),
    ]
)
STATUS_ROWS = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("stream_status", T.StringType()),
        T.StructField("_since", T.LongType()),
    ]
)


def _longs(values) -> list:
    """Nullable whole numbers as Python values for the state."""
    return [None if pd.isna(v) else int(v) for v in values]


def _set_timer(state: GroupState, at_us: int | None) -> None:
    """Wake up once the watermark has passed ``at_us``."""
    if at_us is not None:
        state.setTimeoutTimestamp(-(-at_us // 1000))


def _frame_averages(durations: np.ndarray, carried: int, history: int) -> np.ndarray:
    """Average of the ``history`` values before each value after the first
    ``carried`` ones; nulls (NaN) are left out, no value gives NaN."""
    seen = ~np.isnan(durations)
    sums = np.concatenate([[0.0], np.cumsum(np.where(seen, durations, 0.0))])
    counts = np.concatenate([[0], np.cumsum(seen)])
    end = np.arange(carried, len(durations))
    start = np.maximum(end - history, 0)
    n = counts[end] - counts[start]
    return np.divide(sums[end] - sums[start], n, out=np.full(len(end), np.nan), where=n > 0)


def _spike_update(factor: float, history: int):
    def update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        ts, ids, durations, names, ring = [list(x) for x in state.get] if state.exists else [[], [], [], [], []]
        if not state.hasTimedOut:
            for pdf in pdfs:
                ts += _longs(pdf["_ts"])
                ids += _longs(pdf["batch_id"])
                durations += _longs(pdf["batch_duration_ms"])
                names += list(pdf["query_name"])
        held = pd.DataFrame({"ts": ts, "batch_id": pd.array(ids, "Int64"), "duration": pd.array(durations, "Int64"), "name": names})
        held = held.sort_values(["batch_id", "ts"], kind="mergesort")
        due, rest = held[held["ts"] <= watermark], held[held["ts"] > watermark]
        values = np.concatenate([pd.array(ring, "Int64").to_numpy("float64", na_value=np.nan), due["duration"].to_numpy("float64", na_value=np.nan)])
        average = _frame_averages(values, len(ring), history)
        state.update(
            (_longs(rest["ts"]), _longs(rest["batch_id"]), _longs(rest["duration"]), list(rest["name"]), (ring + _longs(due["duration"]))[-history:])
        )
        _set_timer(state, int(rest["ts"].min()) if len(rest) else None)
        spike = values[len(ring):] > factor * average
        hits = due[spike]
        if len(hits):
            yield pd.DataFrame(
                {"query_id": key[0], "query_name": hits["name"], "batch_id": hits["batch_id"], "batch_duration_ms": hits["duration"], "_avg": average[spike]},
                columns=SPIKE_ROWS.names,
            )

    return update


def duration_spike_stream(prog: DataFrame, delay: str, factor: float = C.SPIKE_FACTOR, history: int = C.SPIKE_HISTORY_ROWS) -> DataFrame:
    """T8 / W4 on a stream: batches longer than ``factor`` times the average
    of the previous ``history`` batches of the stream, each emitted once the
    watermark (``delay`` behind the newest row) has passed it.  Rows may come
    in any order within ``delay``; rows without a timestamp or stream id are
    left out."""
    rows = (
        prog.filter(F.col("timestamp").isNotNull() & F.col("query_id").isNotNull())
        .withWatermark("timestamp", delay)
        .select("timestamp", "query_id", "query_name", "batch_id", "batch_duration_ms", F.unix_micros("timestamp").alias("_ts"))
    )
    hits = rows.groupBy("query_id").applyInPandasWithState(_spike_update(factor, history), SPIKE_ROWS, SPIKE_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return hits.select(
        "query_id",
        "query_name",
        "batch_id",
        "batch_duration_ms",
        round_half_up("_avg", 0).alias("rolling_avg_duration_ms"),
        round_half_up(F.col("batch_duration_ms") / F.nullif(F.col("_avg"), F.lit(0.0)), 2).alias("spike_factor"),
    )


def _status_update(threshold_us: int):
    def update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs() * 1000
        ts, names, last, last_name, inactive = state.get if state.exists else ([], [], None, None, False)
        ts, names = list(ts), list(names)
        if not state.hasTimedOut:
            for pdf in pdfs:
                ts += _longs(pdf["_ts"])
                names += list(pdf["query_name"])
        held = pd.DataFrame({"ts": np.asarray(ts, dtype=np.int64), "name": np.asarray(names, dtype=object)}).sort_values("ts", kind="mergesort")
        due, rest = held[held["ts"] <= watermark], held[held["ts"] > watermark]
        out = []
        for at, name in zip(due["ts"].tolist(), due["name"].tolist()):
            silent = last is not None and at - last > threshold_us
            if silent and not inactive:
                out.append((key[0], last_name, "INACTIVE", last + threshold_us))
            if last is None or silent:
                out.append((key[0], name, "ACTIVE", at))
            last, last_name, inactive = at, name, False
        if last is not None and not inactive and watermark > last + threshold_us:
            out.append((key[0], last_name, "INACTIVE", last + threshold_us))
            inactive = True
        state.update((rest["ts"].tolist(), rest["name"].tolist(), last, last_name, inactive))
        timers = rest["ts"].tolist()[:1] + ([last + threshold_us] if last is not None and not inactive else [])
        # a timer fires when the watermark is past it; one that the watermark
        # has just reached is set a millisecond later
        _set_timer(state, max(min(timers), watermark + 1) if timers else None)
        if out:
            yield pd.DataFrame(out, columns=STATUS_ROWS.names)

    return update


def stream_status_changes(prog: DataFrame, delay: str, cfg: MonitorConfig) -> DataFrame:
    """A4 on a stream: one row whenever a monitored stream becomes ACTIVE (its
    first batch, or the first after a silence) or INACTIVE (no batch for more
    than ``cfg.inactivity_minutes``).  An INACTIVE row comes from a timer:
    it appears because nothing arrived while other streams moved the
    watermark on; ``since`` is the moment the limit was reached."""
    rows = (
        prog.filter(F.col("timestamp").isNotNull() & F.col("query_id").isNotNull())
        .withWatermark("timestamp", delay)
        .select("timestamp", "query_id", "query_name", F.unix_micros("timestamp").alias("_ts"))
    )
    update = _status_update(cfg.inactivity_minutes * 60_000_000)
    changes = rows.groupBy("query_id").applyInPandasWithState(update, STATUS_ROWS, STATUS_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return changes.select("query_id", "query_name", "stream_status", F.timestamp_micros("_since").alias("since"))
