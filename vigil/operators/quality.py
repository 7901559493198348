"""Data-quality measures of a micro-batch.

The reference only declares these columns (and fills them with random
stubs); here they are measured on the data.  Every measure is a grouped
aggregate over (stream, batch) keys, so it runs per micro-batch inside
``foreachBatch`` and over history in batch, with partial aggregation before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators import frames


def null_rates(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``null_rate_by_column`` = map column -> fraction of null values."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.col(c).isNull().cast("bigint")).alias(f"_z{i}") for i, c in enumerate(columns)]
    g = df.groupBy(*group).agg(*aggs)
    rates = F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]),
        F.array(*[(F.col(f"_z{i}") / F.col("_n").cast("double")) for i in range(len(columns))]),
    )
    return g.select(*group, F.col("_n").alias("record_count"), rates.alias("null_rate_by_column"))


def duplicate_rate(df: DataFrame, group: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(rows - distinct keys) / rows per group.

    Exact distinct count: Catalyst plans it as an aggregate on
    (group, key) first, so a hot group is spread over its keys."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("record_count"), F.count_distinct(*key).alias("distinct_keys")).select(
        *group,
        "record_count",
        "distinct_keys",
        ((F.col("record_count") - F.col("distinct_keys")) / F.col("record_count").cast("double")).alias("duplicate_rate"),
    )


def json_key_set(doc: Column) -> Column:
    """Sorted top-level keys of a JSON object (null for non-objects)."""
    return F.array_sort(F.json_object_keys(doc))


def schema_drift(df: DataFrame, stream: str, batch: str, doc: Column, block_rows: int | None = None, chunk: Column | None = None) -> DataFrame:
    """Per (stream, batch): the key set of the documents, and whether it
    differs from the previous batch of the stream (first batch: False).

    The per-batch key set is a small aggregate (distinct key sets of one
    batch); comparing with the previous batch is a one-row-back frame."""
    keys = df.select(F.col(stream), F.col(batch), json_key_set(doc).alias("_k"))
    per_batch = keys.groupBy(stream, batch).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_k")))).alias("key_set"))
    lagged = frames.rows_frame(per_batch, [stream], [batch], 1, lambda w: {"_prev": F.lag("key_set").over(w)}, block_rows, chunk)
    return lagged.select(
        stream,
        batch,
        "key_set",
        F.size("key_set").alias("key_count"),
        F.coalesce(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("key_set")), F.lit(False)).alias("schema_change_detected"),
    )


def event_time_marks(df: DataFrame, stream: str, event_time: str, carried: DataFrame | None = None) -> DataFrame:
    """Newest event time per stream (``stream``, ``mark``) of ``df`` and of
    marks carried over from earlier rows."""
    rows = df.select(F.col(stream).alias("stream"), F.col(event_time).alias("mark"))
    return (rows if carried is None else rows.unionByName(carried.select("stream", "mark"))).groupBy("stream").agg(F.max("mark").alias("mark"))


def late_fraction(
    df: DataFrame, stream: str, batch: str, event_time: str, delay_seconds: int, chunk: Column | None = None, carried: DataFrame | None = None
) -> DataFrame:
    """Fraction of a batch's rows whose event time is older than the
    watermark in force for that batch: (max event time of the stream's
    earlier batches) - delay.  Rows of the first batch are never late.

    The running maximum is taken over the per-batch maxima (one row per
    batch), so no window ever holds raw rows.  ``carried`` holds the marks
    (``event_time_marks``) of batches before those in ``df``: the live form
    passes the marks of all earlier micro-batches."""
    per_batch = df.groupBy(stream, batch).agg(F.max(event_time).alias("_bmax"))
    prior = frames.max_before(per_batch, [stream], batch, "_bmax", "_prior", chunk)
    if carried is not None:
        known = carried.select(F.col("stream").alias("_stream"), F.col("mark").alias("_mark"))
        prior = prior.join(known, F.col(stream) == F.col("_stream"), "left").withColumn("_prior", F.greatest("_prior", "_mark"))
    marks = prior.select(stream, batch, (F.col("_prior") - F.make_dt_interval(secs=F.lit(delay_seconds))).alias("_wm"))
    joined = df.join(marks, [stream, batch])
    late = F.coalesce(F.col(event_time) < F.col("_wm"), F.lit(False))
    return joined.groupBy(stream, batch).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(late.cast("bigint")).alias("late_records"),
        F.avg(late.cast("double")).alias("late_record_percentage"),
    )


def observe_quality(df: DataFrame, key: str, drop_rules: Sequence[tuple[str, str]] = (), name: str = "quality") -> DataFrame:
    """U1 / U4, live form: per micro-batch figures observed while the batch
    runs (no extra job) and reported in its progress event under
    ``observedMetrics[name]``, where the listener captures them and silver
    reads them as ``observedMetrics.quality``.

    ``dropped_record_count`` counts rows violating any drop rule (exact);
    ``duplicate_rate`` uses ``approx_count_distinct`` (observed metrics allow
    no exact distinct count; the exact figure is ``duplicate_rate`` in
    ``foreachBatch``)."""
    bad = F.lit(False)
    for _, pred in drop_rules:
        bad = bad | ~F.coalesce(F.expr(pred), F.lit(False))
    n = F.count(F.lit(1))
    return df.observe(
        name,
        F.sum(bad.cast("bigint")).alias("dropped_record_count"),
        ((n - F.approx_count_distinct(key)) / F.greatest(n, F.lit(1)).cast("double")).alias("duplicate_rate"),
        F.lit(None).cast("double").alias("late_record_percentage"),
    )
