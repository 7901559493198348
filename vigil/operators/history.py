"""Duplicates of a micro-batch against everything that came before it.

A row of a batch repeats if its key came in an earlier batch of its source.
Each batch leaves one theta sketch per source beside its rows, and a second
one of all keys up to it, so the next batch meets its history as one sketch
per source: the intersection of the two estimates the repeated keys without
reading an earlier row.  Only sources whose estimate is above ``tolerance``
are confirmed exactly, against the stored keys of those sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: 2^14 hashes (128 KB) a sketch: exact up to as many keys, then a relative
#: error of about 0.8 % of the union.
LG_ENTRIES = 14


def _key(columns: Sequence[str]) -> Column:
    """The key as one text; null columns count as values of their own."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})


def _stored(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Rows of earlier batches; None before the first."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return df.where(F.col("batch_id") < batch_id)


def _replace(df: DataFrame, path: str, batch_id: int) -> None:
    """The batch's own partition, replaced by a replay."""
    df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def sketched(rows: DataFrame, before: DataFrame | None, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """(source, record_count, distinct_estimate, repeated_estimate, upto) of a
    batch of (source, key) rows and the newest history row of each source
    (source, upto).  ``upto`` covers history and batch; a source without rows
    in this batch hands its history on."""
    new = rows.groupBy("source").agg(F.count(F.lit(1)).alias("record_count"), F.theta_sketch_agg("key", lg_entries).alias("_new"))
    if before is None:
        joined = new.withColumn("_old", F.lit(None).cast("binary"))
    else:
        old = before.select(F.col("source").alias("_source"), F.col("upto").alias("_old"))
        joined = new.join(old, F.col("source").eqNullSafe(F.col("_source")), "full_outer").withColumn("source", F.coalesce("source", "_source"))
    both = F.col("_new").isNotNull() & F.col("_old").isNotNull()
    return joined.select(
        "source",
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.coalesce(F.when(F.col("_new").isNotNull(), F.theta_sketch_estimate("_new")), F.lit(0)).alias("distinct_estimate"),
        F.when(both, F.theta_sketch_estimate(F.theta_intersection("_new", "_old"))).otherwise(F.lit(0)).alias("repeated_estimate"),
        F.when(both, F.theta_union("_new", "_old", lg_entries)).otherwise(F.coalesce("_new", "_old")).alias("upto"),
    )


def suspects(figures: DataFrame, tolerance: float) -> DataFrame:
    return figures.where(F.col("repeated_estimate") > F.lit(tolerance) * F.col("distinct_estimate"))


def confirmed(rows: DataFrame, earlier: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, repeated_rows): the exact count for the given sources.

    Earlier keys are made distinct before the join, so a key met a million
    times before costs one row; a hot source is spread over its keys."""
    some = sources.select(F.col("source").alias("_s"))
    mine = rows.join(some, F.col("source").eqNullSafe(F.col("_s")), "left_semi")
    known = earlier.select("source", "key").join(some, F.col("source").eqNullSafe(F.col("_s")), "left_semi").distinct()
    known = known.select(F.col("source").alias("_source"), F.col("key").alias("_key"))
    hit = mine.join(known, F.col("source").eqNullSafe(F.col("_source")) & (F.col("key") == F.col("_key")), "left_semi")
    return hit.groupBy("source").agg(F.count(F.lit(1)).alias("repeated_rows"))


def record_batch(df: DataFrame, root: str, batch_id: int, source: str, key: Sequence[str], tolerance: float = 0.01, lg_entries: int = LG_ENTRIES) -> None:
    """Measure one micro-batch against its history and store it, for
    ``foreachBatch``: batches come in the order of their ids, a replayed batch
    replaces itself.

    Below ``root``: ``keys`` (source, key), ``sketches`` (the figures of
    ``sketched``; one row per source and batch) and ``repeats`` (source,
    record_count, distinct_estimate, repeated_estimate, confirmed,
    repeated_rows; ``repeated_rows`` is exact where ``confirmed``, else null and
    the estimate is within the tolerance).  A null source is a source; an empty
    batch hands the histories on."""
    spark = df.sparkSession
    rows = df.select(F.col(source).cast("string").alias("source"), _key(key).alias("key"))
    _replace(rows, f"{root}/keys", batch_id)
    rows = spark.read.schema("source string, key string, batch_id bigint").parquet(f"{root}/keys").where(F.col("batch_id") == batch_id).select("source", "key")
    done = _stored(spark, f"{root}/sketches", batch_id)
    last = None if done is None else done.agg(F.max("batch_id")).first()[0]
    before = None if last is None else done.where(F.col("batch_id") == last)
    _replace(sketched(rows, before, lg_entries), f"{root}/sketches", batch_id)
    figures = spark.read.parquet(f"{root}/sketches").where((F.col("batch_id") == batch_id) & (F.col("record_count") > 0)).drop("upto", "batch_id")
    sources = suspects(figures, tolerance)
    out = figures.withColumns({"confirmed": F.lit(False), "repeated_rows": F.lit(None).cast("bigint")})
    if last is not None and not sources.isEmpty():
        exact = confirmed(rows, _stored(spark, f"{root}/keys", batch_id), sources).select(F.col("source").alias("_s"), F.col("repeated_rows").alias("_n"))
        suspect = F.col("repeated_estimate") > F.lit(tolerance) * F.col("distinct_estimate")
        out = figures.join(exact, F.col("source").eqNullSafe(F.col("_s")), "left").withColumns({"confirmed": suspect, "repeated_rows": F.when(suspect, F.coalesce("_n", F.lit(0)))}).drop("_s", "_n")
    _replace(out, f"{root}/repeats", batch_id)
