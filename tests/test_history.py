"""Duplicates of a batch against its history."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from vigil.operators import history



def spark_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, data):
    return spark.createDataFrame(data, "src string, k long, other string")


def record(spark, root, batch, data, **kw):
    history.record_batch(rows(spark, data), root, batch, "src", ["k"], **kw)


def repeats(spark, root):
    out = spark.read.parquet(f"{root}/repeats").select("source", "batch_id", "record_count", "repeated_estimate", "confirmed", "repeated_rows")
    return sorted((tuple(r) for r in out.collect()), key=lambda r: (r[1], r[0] or "~"))


def test_repeats_against_all_earlier_batches(spark):
    root = tempfile.mkdtemp(prefix="vigil-history-")
    record(spark, root, 0, [("a", 1, "x"), ("a", 1, "y"), ("b", 1, "x"), (None, None, "x")])
    record(spark, root, 1, [("a", 2, "x"), ("b", 1, "x"), ("b", 1, "x"), (None, None, "x")])
    record(spark, root, 2, [])
    record(spark, root, 3, [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("c", 1, "x")])
    want = [
        ("a", 0, 2, 0, False, None), ("b", 0, 1, 0, False, None), (None, 0, 1, 0, False, None),
        ("a", 1, 1, 0, False, None), ("b", 1, 2, 1, True, 2), (None, 1, 1, 1, True, 1),
        ("a", 3, 3, 2, True, 2), ("c", 3, 1, 0, False, None),
    ]
    assert repeats(spark, root) == want
    record(spark, root, 3, [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("c", 1, "x")])  # a replay
    assert repeats(spark, root) == want


def test_small_sketches_stay_near_the_truth(spark):
    root = tempfile.mkdtemp(prefix="vigil-history-big-")
    df = lambda lo, hi: spark.range(lo, hi).select(F.lit("s").alias("src"), F.col("id").alias("k"))
    history.record_batch(df(0, 50_000), root, 0, "src", ["k"], lg_entries=12)
    history.record_batch(df(30_000, 80_000), root, 1, "src", ["k"], lg_entries=12)
    history.record_batch(df(80_000, 130_000), root, 2, "src", ["k"], lg_entries=12)
    got = {r.batch_id: r for r in spark.read.parquet(f"{root}/repeats").collect()}
    assert got[1].confirmed and got[1].repeated_rows == 20_000 and abs(got[1].repeated_estimate - 20_000) < 2_000
    assert not got[2].confirmed and got[2].repeated_estimate <= 0.01 * 50_000


def test_earlier_rows_are_not_read_below_the_tolerance(spark):
    root = tempfile.mkdtemp(prefix="vigil-history-plan-")
    record(spark, root, 0, [("a", 1, "x")])
    before = history._stored(spark, f"{root}/sketches", 1)
    p = spark_plan(history.sketched(rows(spark, [("a", 2, "x")]).select(F.col("src").alias("source"), F.col("k").cast("string").alias("key")), before))
    assert "sketches" in p and f"{root}/keys" not in p
    assert "Join" in p and "CartesianProduct" not in p and "NestedLoop" not in p
