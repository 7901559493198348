"""Row expectations (P18, P19): warn (count, keep rows) and drop (filter).

A rule is ``(name, SQL predicate)``.  A row violates a rule when the
predicate is false *or* null.  Counting is a single aggregate pass (batch)
or a ``DataFrame.observe`` (stream: the counts arrive with each
micro-batch's progress event, no extra job).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The expectation rules of the monitoring pipeline.
BRONZE_RULES = [
    ("valid_timestamp", "timestamp IS NOT NULL"),
    ("valid_event_type", "event_type IS NOT NULL"),
]
SILVER_METRICS_RULES = [
    ("valid_details", "details IS NOT NULL"),
    ("is_stream_progress", "event_type = 'stream_progress'"),
]
SLA_RULES = [("has_event_time", "event_time_max IS NOT NULL")]
ERROR_DROP_RULE = ("is_error_event", "level IN ('ERROR', 'WARN')")


def _ok(pred: str) -> Column:
    return F.coalesce(F.expr(pred), F.lit(False))


def violation_counts(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per rule: rule, total rows, failed rows, passed rows."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [F.sum(F.when(_ok(p), 0).otherwise(1)).cast("bigint").alias(f"_f{i}") for i, (_, p) in enumerate(rules)]
    row = df.agg(*aggs)
    stack = ", ".join(f"'{n}', _f{i}" for i, (n, _) in enumerate(rules))
    out = row.select(F.col("_total"), F.expr(f"stack({len(rules)}, {stack}) AS (expectation, failed_records)"))
    return out.select(
        "expectation",
        F.col("_total").alias("total_records"),
        F.coalesce(F.col("failed_records"), F.lit(0).cast("bigint")).alias("failed_records"),
        (F.col("_total") - F.coalesce(F.col("failed_records"), F.lit(0).cast("bigint"))).alias("passed_records"),
    )


def expect(df: DataFrame, rules: Sequence[tuple[str, str]], name: str = "expectations") -> tuple[DataFrame, Observation | str]:
    """Warn form: rows pass through unchanged; violation counts are
    observed as the DataFrame is computed.

    Batch: returns an ``Observation`` (``.get`` after the action).  Stream:
    returns the observation name; each micro-batch's counts appear in its
    progress event under ``observedMetrics[name]`` (and so reach the
    captured event log)."""
    metrics = [F.count(F.lit(1)).alias("total_records")] + [F.sum(F.when(_ok(p), 0).otherwise(1)).alias(n) for n, p in rules]
    if df.isStreaming:
        return df.observe(name, *metrics), name
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def expect_or_drop(df: DataFrame, rule: tuple[str, str]) -> DataFrame:
    """Drop form: keep only rows satisfying the predicate (null = drop)."""
    return df.filter(_ok(rule[1]))


def drop_counts(df: DataFrame, rule: tuple[str, str]) -> DataFrame:
    """Kept and dropped counts of a drop rule, in one pass."""
    ok = _ok(rule[1])
    return df.agg(
        F.lit(rule[0]).alias("expectation"),
        F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("kept_records"),
        F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias("dropped_records"),
    )
