"""Refresh by delta: what it reads, which later days it reaches, and that it
falls back where batch ids do not follow days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from sf_paths import SF0001

from vigil.plans import datasets, delta
from vigil.plans.context import Context

CFG = Context(None, SF0001).cfg.with_(lookback_days=None)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from vigil.sources.event_log import append_event_log, read_event_log

    root = str(tmp_path_factory.mktemp("delta"))
    append_event_log(Context(spark, SF0001).bronze, f"{root}/raw")
    datasets.materialize(spark, read_event_log(spark, f"{root}/raw"), root, CFG)
    days = sorted(r[0] for r in spark.read.parquet(f"{root}/stream_progress").select("event_date").distinct().collect())
    return root, days


def scans(df, table):
    """The partition filters of every scan of ``table`` in the physical plan."""
    text = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [n for n in text.split("\n\n") if "Location" in n and f"/{table}]" in n]


def test_refresh_reads_its_days_and_the_state(spark, lake):
    root, days = lake
    inputs = datasets.Inputs(spark, None, root)
    two = days[5:7]
    for name in delta.FRAMES:
        rows = delta.frame_rows(inputs, name, CFG, two)
        found = scans(rows, "stream_progress")
        assert found
        for node in found:
            assert all(str(d) in node.split("PartitionFilters:")[1].split("\n")[0] for d in two), node
        assert scans(rows, "_tails")
        assert {str(r[0]) for r in rows.select("event_date").distinct().collect()} == {str(d) for d in two}
    clock = CFG.with_(as_of=f"{days[8]} 10:00:00")
    for table in ("stream_progress", "stream_errors", "sla_latency_metrics"):
        for node in scans(delta.overview(inputs, clock), table):
            assert f"= {days[8]}" in node.split("PartitionFilters:")[1].split("\n")[0], node


def test_every_single_day_equals_the_whole(spark, lake):
    root, days = lake
    inputs = datasets.Inputs(spark, None, root)
    prog = inputs.stored("stream_progress")
    for name, (_, build) in delta.FRAMES.items():
        whole = build(prog, CFG).withColumn("event_date", F.to_date("timestamp"))
        for chosen in ([days[0]], [days[9]], [days[3], days[10], days[-1]]):
            want = whole.filter(F.col("event_date").isin(chosen))
            got = delta.frame_rows(inputs, name, CFG, chosen)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_reached_days(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 8)]
    rows = [("a", d[i], 2, 2 * i, 2 * i + 1) for i in range(6)] + [("b", d[0], 9, 0, 8), ("b", d[6], 9, 9, 17)]
    b = spark.createDataFrame(rows, "query_id string, event_date date, flag_rows long, first_batch_id long, last_batch_id long").withColumn("state_rows", F.col("flag_rows"))
    assert delta.reached_days(b, [d[1]], "flag") == d[1:4]  # 4 rows after it lie in two days
    assert delta.reached_days(b, [d[1]], "state") == d[1:3]
    assert delta.reached_days(b, [d[0]], "state") == [d[0], d[1], d[6]]
    back = b.unionByName(spark.createDataFrame([("a", d[6], 1, 0, 0, 1)], "query_id string, event_date date, flag_rows long, first_batch_id long, last_batch_id long, state_rows long"))
    assert delta.reached_days(back, [d[1]], "flag") is None
