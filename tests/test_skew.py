"""One stream holding every row: the split row frame spreads it over many
tasks and still equals the unsplit window."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import frames


def test_single_hot_stream_is_split_over_tasks(spark):
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    # every event is a batch of the same stream, in event-id order
    df = ev.select(F.lit("hot").alias("query_id"), F.col("event_id").alias("batch_id"), (F.col("value") > 25).cast("int").alias("flag"))

    def build(w):
        return {"s5": F.sum("flag").over(w.rowsBetween(-4, 0)), "prev": F.lag("batch_id").over(w)}

    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain = frames.rows_frame(df, ["query_id"], ["batch_id"], 4, build, None).withColumn("_task", F.spark_partition_id())
        split = frames.rows_frame(df, ["query_id"], ["batch_id"], 4, build, 8192, F.floor(F.col("batch_id") / 16384)).withColumn("_task", F.spark_partition_id())
        p_rows = plain.collect()
        s_rows = split.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    assert len({r["_task"] for r in p_rows}) == 1  # the whole stream in one task
    assert len({r["_task"] for r in s_rows}) >= 4  # spread by block

    def strip(rows):
        return sorted((r["batch_id"], r["flag"], r["s5"], r["prev"]) for r in rows)

    assert len(s_rows) == ev.count()
    assert strip(p_rows) == strip(s_rows)
