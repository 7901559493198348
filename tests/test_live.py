"""Live detectors, as-of tags, the sweep-line back-test, stored sketches and
display ranks on small fixtures."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import asof, evaluate, gold
from vigil.streaming import ordered

T0 = dt.datetime(2024, 1, 1)
US = 1_000_000


class FakeState:
    """The part of a group state that the update functions use."""

    def __init__(self):
        self.exists, self.get, self.hasTimedOut, self.timer, self.wm = False, None, False, None, 0

    def getCurrentWatermarkMs(self):
        return self.wm

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, ms):
        assert ms > self.wm
        self.timer = ms


def _drain(update, state, batches):
    """Rows emitted for (rows, watermark in ms) batches; None rows: a timer."""
    out = []
    for rows, wm in batches:
        state.wm, state.hasTimedOut = wm, rows is None
        if rows is None:
            assert state.timer is not None and state.timer <= wm
        state.timer = None
        out += [r for pdf in update(("q",), iter([] if rows is None else [rows]), state) for r in pdf.itertuples(index=False, name=None)]
    return out


def _spikes(durations, factor=3.0, history=20):
    hits = []
    for i, d in enumerate(durations):
        before = [x for x in durations[max(0, i - history):i] if x is not None]
        if d is not None and before and d > factor * (sum(before) / len(before)):
            hits.append(i)
    return hits


@pytest.mark.parametrize("seed", range(5))
def test_spikes_do_not_depend_on_arrival_order(seed):
    rng = np.random.default_rng(seed)
    n = 200
    durations = [None if x < 0.1 else int(y) for x, y in zip(rng.random(n), rng.pareto(1.0, n) * 100)]
    late = rng.integers(0, 15, n)
    arrival = np.argsort(np.arange(n) + late, kind="stable")
    batches, seen = [], -1
    for part in np.array_split(arrival, 12):
        rows = pd.DataFrame({"_ts": part * US, "batch_id": part, "batch_duration_ms": [durations[i] for i in part], "query_name": "s"})
        batches.append((rows, max(0, seen - 15) * 1000))
        seen = max(seen, int(part.max()))
    state = FakeState()
    got = _drain(ordered._spike_update(3.0, 20), state, batches + [(None, n * 1000)])
    assert [r[2] for r in got] == _spikes(durations)
    assert state.get[:4] == ([], [], [], []) and len(state.get[4]) == 20


def test_spike_state_holds_one_delay_only():
    state = FakeState()
    update = ordered._spike_update(3.0, 20)
    for k in range(50):
        ids = np.arange(k * 10, k * 10 + 10)
        rows = pd.DataFrame({"_ts": ids * US, "batch_id": ids, "batch_duration_ms": 5, "query_name": "s"})
        _drain(update, state, [(rows, max(0, k * 10 - 20) * 1000)])
        assert len(state.get[0]) <= 30


def test_inactive_by_timer_and_active_again():
    minute = 60 * US
    update = ordered._status_update(10 * minute)
    rows = lambda *m: pd.DataFrame({"_ts": [x * minute for x in m], "query_name": "s"})
    state = FakeState()
    got = _drain(update, state, [(rows(5, 1, 3), 0), (None, 16 * 60_000), (rows(20, 30), 18 * 60_000), (None, 35 * 60_000), (None, 41 * 60_000)])
    assert [(r[2], r[3] // minute) for r in got] == [("ACTIVE", 1), ("INACTIVE", 15), ("ACTIVE", 20), ("INACTIVE", 40)]
    assert state.timer is None


def test_inactive_when_no_timer_fired_in_between():
    minute = 60 * US
    state = FakeState()
    rows = pd.DataFrame({"_ts": [minute, 30 * minute], "query_name": "s"})
    got = _drain(ordered._status_update(10 * minute), state, [(rows, 0), (None, 31 * 60_000)])
    assert [(r[2], r[3] // minute) for r in got] == [("ACTIVE", 1), ("INACTIVE", 11), ("ACTIVE", 30)]


def test_watermark_that_just_reaches_the_limit():
    minute = 60 * US
    state = FakeState()
    rows = pd.DataFrame({"_ts": [minute], "query_name": "s"})
    assert len(_drain(ordered._status_update(10 * minute), state, [(rows, 0), (None, 11 * 60_000)])) == 1
    assert state.timer == 11 * 60_000 + 1


def test_as_of_against_plain_search(spark):
    rng = np.random.default_rng(1)
    at = lambda n: [None if x == 0 else T0 + dt.timedelta(hours=int(x)) for x in rng.integers(0, 90, n)]
    key = lambda n: [None if x == 3 else "abc"[x] for x in rng.integers(0, 4, n)]
    left = list(zip(range(80), key(80), at(80), ["mine"] * 80)) * 2
    right = list(zip(key(60), at(60), range(60), [None if i % 7 == 0 else f"o{i}" for i in range(60)]))
    l = spark.createDataFrame(left, "i int, k string, t timestamp, owner string")
    r = spark.createDataFrame(right, "k string, since timestamp, v int, owner string")
    got = asof.as_of(l, r, ["k"], "t", "since", ["owner"], "v", chunk_seconds=7200)
    assert got.columns == ["i", "k", "t", "owner"]

    def found(k, t):
        c = [(s, v, o) for kk, s, v, o in right if None not in (k, t, kk, s) and kk == k and s <= t]
        return max(c, key=lambda x: x[:2])[2] if c else None

    want = [(i, found(k, t)) for i, k, t, _ in left]
    assert sorted((x.i, x.owner or "") for x in got.collect()) == sorted((i, o or "") for i, o in want)


def test_as_of_empty_sides(spark):
    l = spark.createDataFrame([(1, "a", T0)], "i int, k string, t timestamp")
    r = spark.createDataFrame([], "k string, since timestamp, v int, owner string")
    assert [x.owner for x in asof.as_of(l, r, ["k"], "t", "since", ["owner"], "v").collect()] == [None]
    assert asof.as_of(l.limit(0), r, ["k"], "t", "since", ["owner"], "v").count() == 0


@pytest.mark.parametrize("lookback,step", [(10, 300), (10, 3600), (1, 300), (600, 60)])
def test_sweep_line_counts_like_copies(spark, lookback, step):
    rng = np.random.default_rng(2)
    rows = [(None if e == 2 else f"e{e}", T0 + dt.timedelta(seconds=int(s))) for e, s in zip(rng.integers(0, 3, 120), rng.integers(-4000, 12000, 120))]
    df = spark.createDataFrame(rows, "entity string, timestamp timestamp")
    end = T0 + dt.timedelta(hours=2)
    got = evaluate.backtest_counts(df, "d", "entity", lookback, step, T0, end)
    copies = evaluate.backtest_rows(df, lookback, step, T0, end).groupBy("entity", "_t").count()
    want = {(r.entity, r._t): r["count"] for r in copies.collect()}
    back = got.select("entity", F.unix_seconds("evaluated_at").alias("t"), "value").collect()
    assert len(back) == len(want) and {(r.entity, r.t): r.value for r in back} == want


def test_sketch_error_on_many_values(spark):
    """100 000 latencies in 5-minute buckets, merged: ranks within 0.02."""
    sla = spark.range(100_000).select(
        F.lit("s").alias("query_name"), F.lit("prod").alias("environment"), F.lit(10).cast("bigint").alias("sla_threshold_ms"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"), ((F.col("id") * 7919) % 100_003).alias("latency_ms"),
    ).withColumns({"max_latency": F.col("latency_ms"), "sla_breach_flag": F.col("latency_ms") > 10})
    cfg = MonitorConfig(lookback_days=None, as_of="2024-02-01 00:00:00")
    got = gold.latency_from_sketches(gold.latency_sketches(sla, cfg), None).first()
    assert got.batch_count == 100_000
    for p, q in ((got.p50_latency_ms, 0.5), (got.p90_latency_ms, 0.9), (got.p99_latency_ms, 0.99)):
        assert abs(sla.filter(F.col("latency_ms") <= p).count() / 100_000 - q) < 0.02


def test_display_ranks_cross_partitions(spark):
    from vigil.plans.checks import _ranked
    from vigil.plans.context import Context

    df = spark.range(1000).select(((F.col("id") * 37) % 1000).alias("x")).repartition(7).orderBy("x")
    c = Context(spark, "/none")
    rows = _ranked(c, df).collect()
    assert len(rows) == 1000 and all(r.display_rank == r.x + 1 for r in rows)


@pytest.mark.parametrize("lookback,step,block", [(10, 300, 3), (10, 3600, 3), (2, 60, None), (600, 60, 4)])
def test_state_growth_sweep(spark, lookback, step, block):
    """Against every instant's own lookback, with ties, gaps and nulls."""
    rng = np.random.default_rng(4)
    rows = [
        (f"s{q}", T0 + dt.timedelta(seconds=int(s), milliseconds=int(ms)), int(b), None if m == 0 else int(m))
        for q, s, ms, b, m in zip(rng.integers(0, 2, 60), rng.integers(-3000, 9000, 60), rng.integers(0, 2, 60) * 500, rng.permutation(60), rng.integers(0, 9, 60))
    ]
    rows += [(q, t, b + 100, m) for q, t, b, m in rows[:20]]
    df = spark.createDataFrame(rows, "query_name string, timestamp timestamp, batch_id long, state_memory_bytes long")
    got = evaluate.backtest_state_growth(df, lookback, step, T0, T0 + dt.timedelta(hours=2), block, 1800)
    want = {}
    for t in range(0, 7201, step):
        for q in ("s0", "s1"):
            seen = sorted((ts, b, m) for qq, ts, b, m in rows if qq == q and t - lookback * 60 <= (ts - T0) // dt.timedelta(seconds=1) <= t)
            if seen and seen[0][2] and seen[-1][2] is not None:
                want[q, t] = 100.0 * (seen[-1][2] - seen[0][2]) / seen[0][2]
    have = {(r.entity, r.t): r.value for r in got.select("entity", (F.unix_seconds("evaluated_at") - 1704067200).alias("t"), "value").collect()}
    assert have.keys() == want.keys()
    assert all(abs(have[k] - want[k]) < 0.0051 for k in want)


def _evolved(spark, tmp_path, lines_by_drop):
    from vigil import schemas
    from vigil.streaming import evolve

    base = str(tmp_path)
    for lines in lines_by_drop:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{base}/landing")
        evolve.run_evolving_ingest(spark, f"{base}/landing", f"{base}/rows", f"{base}/log", f"{base}/ckpt", schemas.SENSOR_SOURCE)
    return spark.read.parquet(f"{base}/rows"), evolve.schema_changes(spark.read.parquet(f"{base}/log"))


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    import json

    lines = ['{"sensor_id": "a", "temperature": 7}', '{"sensor_id": "b", "temperature": "7.5", "x": {"y": {"z": 1}}}', '{"sensor_id": "c", "temperature": "warm"}',
             '{"sensor_id": null, "temperature": null}', "no json", "[1]", "7", "{}", '{"sensor_id": "d"} tail']
    rows, changes = _evolved(spark, tmp_path, [lines[:2], lines[2:]])
    got = {(r.sensor_id, r.corrupt): r for r in rows.collect()}
    assert len(rows.collect()) == len(lines)
    assert got["a", None].temperature == 7.0 and got["a", None].rescued is None
    assert got["b", None].temperature == 7.5 and json.loads(got["b", None].rescued) == {"x": {"y": {"z": 1}}}
    assert got["c", None].temperature is None and json.loads(got["c", None].rescued) == {"temperature": "warm"}
    assert {r.corrupt for r in rows.collect()} >= {"no json", "[1]", "7"}
    c = {(r.batch_id, r.path, r.type): r.change for r in changes.collect()}
    assert c[0, "$.x.y.z", "NUMBER"] == "INITIAL" and c[1, "$.temperature", "STRING"] == "KNOWN" and c[1, "$.sensor_id", "NULL"] == "NEW TYPE"


def test_drop_without_objects(spark, tmp_path):
    rows, changes = _evolved(spark, tmp_path, [["x", "{}"], ['{"a": [1]}']])
    assert rows.count() == 3
    assert [(r.batch_id, r.path, r.type, r.row_count) for r in changes.collect()] == [(1, "$.a", "ARRAY", 1)]


def test_marks_carry_between_calls(spark):
    from vigil.operators import quality

    rows = [("s", b, T0 + dt.timedelta(days=d)) for b, d in [(0, 10), (0, 1), (1, 12), (1, 3), (2, 2), (2, 30)]] + [("t", 2, T0)]
    df = spark.createDataFrame(rows, "stream string, batch long, at timestamp")
    whole = quality.late_fraction(df, "stream", "batch", "at", 5 * 86400)
    first, rest = df.filter("batch = 0"), df.filter("batch > 0")
    marks = quality.event_time_marks(first, "stream", "at")
    parts = quality.late_fraction(first, "stream", "batch", "at", 5 * 86400).unionByName(quality.late_fraction(rest, "stream", "batch", "at", 5 * 86400, carried=marks))
    assert sorted(whole.collect()) == sorted(parts.collect())
    assert quality.event_time_marks(rest, "stream", "at", marks).count() == 2


def test_batch_schema_reads_a_batch_once(spark):
    from pyspark.sql.types import StringType

    from vigil.streaming import evolve

    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    text = ['{"a": 1, "o": {"x": "s", "y": 2.5}, "e": {}}', '{"a": null, "o": {"y": 1}, "l": [1]}', "{}"]
    rows = spark.createDataFrame([(x,) for x in text], "line string").withColumn("line", F.udf(seen, StringType()).asNondeterministic()("line"))
    got = {(r.path, r.type): r.row_count for r in evolve.batch_schema(rows.withColumn("payload", F.try_parse_json("line"))).collect()}
    assert got == {("$.a", "NUMBER"): 1, ("$.a", "NULL"): 1, ("$.o", "OBJECT"): 2, ("$.o.x", "STRING"): 1, ("$.o.y", "NUMBER"): 2, ("$.e", "OBJECT"): 1, ("$.l", "ARRAY"): 1}
    assert read.value == len(text)


def test_batch_schema_of_deep_objects(spark, tmp_path):
    deep = '{"a": ' * 9 + "7" + "}" * 9
    _, changes = _evolved(spark, tmp_path, [[deep, f" \t{deep}", '{"a": {"b": 1, "a": {}}, "a.a": true}']])
    got = {(r.path, r.type, r.row_count) for r in changes.collect()}
    want = {("$" + ".a" * k, "OBJECT", 2 + (k < 3)) for k in range(1, 9)} | {("$" + ".a" * 9, "NUMBER", 2), ("$.a.b", "NUMBER", 1), ("$.a.a", "BOOLEAN", 1)}
    assert got == want
