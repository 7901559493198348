"""Alert evaluation (U6-U10, J4): rules as data.

* ``evaluate``: detector rows -> (alert, entity, value) -> fired when the
  rule's condition holds (``value > threshold``; COUNT rules count rows).
  Rules are a small configuration table, attached by an equi-join.
* ``route``: severity -> channel, plus the notification text.
* ``backtest``: replays an alert over history on its evaluation grid
  (every ``schedule_interval_seconds``) without a cross join.  Counts and the
  state growth are swept (rows sent on do not grow with the lookback); for
  the row frames each row goes to the grid instants whose lookback covers it.
* ``rearm``: suppresses re-notification within ``rearm_seconds`` of the last
  notification of the same (alert, entity).
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import config as C
from vigil import schemas
from vigil.operators import frames

# ---------------------------------------------------------------------------
# The five alert rules (name, detector, schedule s, operator,
# operand column, threshold, severity, escalation, re-arm s, description).
# ---------------------------------------------------------------------------
RULES = [
    ("streaming_sla_breach", "alert_sla_breach", 300, "GREATER_THAN", None, "breach_count", 0.0, "critical", "pagerduty", 600,
     "Fires when any stream exceeds its SLA latency threshold."),
    ("streaming_sustained_backpressure", "alert_sustained_backpressure", 300, "GREATER_THAN", None, "backpressured_count", 4.0, "warning", "slack", 900,
     "Fires when input > processed for 5+ consecutive batches."),
    ("streaming_batch_duration_spike", "alert_batch_duration_spike", 300, "GREATER_THAN", None, "spike_factor", 3.0, "warning", "slack", 600,
     "Fires when batch duration exceeds 3x the rolling average."),
    ("streaming_stream_terminated", "alert_stream_terminated", 60, "GREATER_THAN", "COUNT", "query_id", 0.0, "failure", "pagerduty", 300,
     "Fires immediately when any streaming query terminates."),
    ("streaming_state_memory_growth", "alert_state_memory_growth", 600, "GREATER_THAN", None, "growth_pct", 20.0, "warning", "slack", 1800,
     "Fires when state store memory grows >20% within 30 minutes."),
]

EVALUATION = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("evaluated_at", T.TimestampType()),
    ]
)


def rules_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, schemas.ALERT_RULE)


def escalation_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(C.ESCALATION.items()), schemas.ESCALATION_SCHEMA)


def to_evaluations(result: DataFrame, detector: str, entity_col: str, value_col: str | None, evaluated_at, count: bool = False) -> DataFrame:
    """Unpivot one detector's rows into (query_name, entity, value, at).
    COUNT rules count rows per entity; value rules keep the column."""
    at = evaluated_at if not isinstance(evaluated_at, (str, dt.datetime)) else F.to_timestamp(F.lit(str(evaluated_at)))
    if count:
        result = result.groupBy(entity_col).agg(F.count(F.lit(1)).cast("double").alias("_v"))
    else:
        result = result.select(F.col(entity_col), F.col(value_col).cast("double").alias("_v"))
    return result.select(F.lit(detector).alias("query_name"), F.col(entity_col).cast("string").alias("entity"), F.col("_v").alias("value"), at.alias("evaluated_at"))


RULE_FIELDS = [f.name for f in schemas.ALERT_RULE.fields]

OPERATORS = {
    "GREATER_THAN": lambda v, t: v > t,
    "GREATER_THAN_OR_EQUAL": lambda v, t: v >= t,
    "LESS_THAN": lambda v, t: v < t,
    "LESS_THAN_OR_EQUAL": lambda v, t: v <= t,
    "EQUAL": lambda v, t: v == t,
    "NOT_EQUAL": lambda v, t: v != t,
}


def evaluate(evaluations: DataFrame, rules=RULES) -> DataFrame:
    """Join each row with the rules of its detector (a rule table or
    rule tuples) and test the condition.

    A row of a detector with several rules yields one row per rule; a row
    of a detector without rules yields none.  A rule whose ``op`` is unknown
    stops the job instead of never firing."""
    if not isinstance(rules, DataFrame):
        rules = evaluations.sparkSession.createDataFrame([tuple(r) for r in rules], schemas.ALERT_RULE)
    r = rules.select(F.col("query_name").alias("_detector"), "name", "op", "threshold", "severity", "rearm_seconds", "description")
    # the key holds an (empty) part of the entity: with the constant name of a
    # single detector alone Catalyst would drop the key and plan a nested loop
    key = F.concat("query_name", F.coalesce(F.substring("entity", 1, 0), F.lit("")))
    j = evaluations.join(r, key == F.col("_detector")).drop("_detector")
    v, t, op = F.col("value"), F.col("threshold"), F.col("op")
    fired = F.when(op.isNull(), F.raise_error(F.concat(F.lit("rule without an operator: "), F.col("name"))).cast("boolean"))
    for name, test in OPERATORS.items():
        fired = fired.when(op == name, test(v, t))
    fired = fired.otherwise(F.raise_error(F.concat(F.lit("unknown rule operator: "), op)).cast("boolean"))
    # a null value (no data) never fires
    return j.withColumn("fired", F.coalesce(fired, F.lit(False)))


def route(evaluated: DataFrame, escalation: DataFrame, environment: str) -> DataFrame:
    """U8 + U10: fired alerts with their channel and notification text."""
    e = escalation.withColumnRenamed("severity", "_sev")
    f = evaluated.filter(F.col("fired")).join(e, F.col("severity") == F.col("_sev"), "left").drop("_sev")
    body = F.format_string(C.ALERT_MESSAGE, F.col("name"), F.col("severity"), F.lit(environment), F.col("description"))
    return f.withColumn("message", body)


def grid_times(ts: str, lookback_seconds: int, step_seconds: int):
    """Evaluation instants t (multiples of the step) with t - lookback <= ts <= t
    (none where a step longer than the lookback passes over the row)."""
    s = F.unix_seconds(F.col(ts))
    first = (F.ceil(s / F.lit(step_seconds)) * step_seconds).cast("bigint")
    last = (F.floor((s + F.lit(lookback_seconds)) / F.lit(step_seconds)) * step_seconds).cast("bigint")
    return F.explode(F.when(first <= last, F.sequence(first, last, F.lit(step_seconds).cast("bigint"))))


def seen_rows(rows: DataFrame, lookback_minutes: int, start, end, ts: str = "timestamp") -> DataFrame:
    """Rows that some instant in [start, end] can see (prunes days on stored
    tables)."""
    first = F.to_timestamp(F.lit(str(start))) - F.expr(f"INTERVAL {int(lookback_minutes)} MINUTES")
    last = F.to_timestamp(F.lit(str(end)))
    cond = (F.col(ts) >= first) & (F.col(ts) <= last)
    if "event_date" in rows.columns:
        cond = cond & (F.col("event_date") >= F.to_date(first)) & (F.col("event_date") <= F.to_date(last))
    return rows.filter(cond)


def backtest_rows(rows: DataFrame, lookback_minutes: int, step_seconds: int, start, end, ts: str = "timestamp") -> DataFrame:
    """U9 core: each row paired with every grid instant ``t`` (a multiple of
    the step, ``start <= t <= end``) whose lookback ``[t - L, t]`` covers it.

    Each row is replicated ``L / step + 1`` times at most; any per-instant
    detector is then an aggregate grouped by (``_t``, entity): a range join
    written as explode + group, never a cross join of rows and instants."""
    lb = lookback_minutes * 60
    lo = F.unix_seconds(F.to_timestamp(F.lit(str(start))))
    hi = F.unix_seconds(F.to_timestamp(F.lit(str(end))))
    t = seen_rows(rows, lookback_minutes, start, end, ts).select("*", grid_times(ts, lb, step_seconds).alias("_t"))
    return t.filter((F.col("_t") >= lo) & (F.col("_t") <= hi))


def backtest_counts(rows: DataFrame, detector: str, entity_col: str, lookback_minutes: int, step_seconds: int, start, end) -> DataFrame:
    """U9 for count-style alerts (SLA breach, termination): for every grid
    instant in [start, end], the rows per entity inside its lookback.

    A sweep line: a row adds one at the first instant that sees it and takes
    one off after the last, so each row is sent on twice at most, whatever the
    lookback and the step (and aggregated per task before it is).  The window
    holds at most one row per entity and grid instant; the instants between
    two changes are filled in after it."""
    from pyspark.sql import Window

    step = int(step_seconds)
    s = F.unix_seconds(F.col("timestamp"))
    lo = F.unix_seconds(F.to_timestamp(F.lit(str(start))))
    hi = F.unix_seconds(F.to_timestamp(F.lit(str(end))))
    first = (F.ceil(F.greatest(s, lo) / F.lit(step)) * step).cast("bigint")
    last = (F.floor(F.least(s + F.lit(lookback_minutes * 60), hi) / F.lit(step)) * step).cast("bigint")
    seen = seen_rows(rows, lookback_minutes, start, end).select(F.col(entity_col).cast("string").alias("entity"), first.alias("_first"), last.alias("_last"))
    ends = F.array(F.struct(F.col("_first").alias("t"), F.lit(1).alias("d")), F.struct((F.col("_last") + step).alias("t"), F.lit(-1).alias("d")))
    change = seen.filter(F.col("_first") <= F.col("_last")).select("entity", F.inline(ends)).groupBy("entity", "t").agg(F.sum("d").alias("d"))
    w = Window.partitionBy("entity").orderBy("t")
    level = change.select("entity", "t", F.sum("d").over(w).cast("double").alias("value"), F.lead("t").over(w).alias("_next"))
    instants = F.explode(F.sequence("t", F.col("_next") - step, F.lit(step).cast("bigint")))
    return level.filter(F.col("value") > 0).select(
        F.lit(detector).alias("query_name"), "entity", "value", instants.alias("_t")
    ).select("query_name", "entity", "value", F.timestamp_seconds("_t").alias("evaluated_at"))


def backtest_state_growth(
    prog: DataFrame, lookback_minutes: int, step_seconds: int, start, end, block_rows: int | None = 1 << 16, chunk_seconds: int = 86_400
) -> DataFrame:
    """U9 for alert 5: per grid instant and stream, state memory at the first
    and last batch of the lookback and the growth percentage (null when the
    first is not positive).

    A sweep: with the times of the rows before and after it, a row knows the
    instants at which it is the last row seen (until the next row comes, or
    it leaves the lookback) and the first (once the row before it has left).
    These spans do not overlap within a stream, so a stream gives at most two
    rows per instant, however long the lookback is."""
    from vigil.functions.core import round_half_up

    step, lb = int(step_seconds), int(lookback_minutes) * 60
    order = ["timestamp", "batch_id"]
    day = F.floor(F.unix_seconds("timestamp") / F.lit(chunk_seconds))
    rows = seen_rows(prog, lookback_minutes, start, end).select("query_name", "timestamp", "batch_id", "state_memory_bytes", F.unix_seconds("timestamp").alias("_s"))
    rows = frames.neighbours(rows, ["query_name"], order, "_s", "_prev", "_after", block_rows, day)
    lo = F.unix_seconds(F.to_timestamp(F.lit(str(start))))
    hi = F.unix_seconds(F.to_timestamp(F.lit(str(end))))

    def span(first, last, oldest, newest):
        """Grid instants of a span of whole seconds within [start, end]."""
        t0 = (F.ceil(F.greatest(first, lo) / F.lit(step)) * step).cast("bigint")
        t1 = (F.floor(F.least(last, hi) / F.lit(step)) * step).cast("bigint")
        return F.struct(t0.alias("t0"), t1.alias("t1"), oldest.alias("oldest"), newest.alias("newest"))

    s, leaves = F.col("_s"), F.col("_s") + lb
    value, none = F.col("state_memory_bytes"), F.lit(None).cast("bigint")
    spans = F.array(span(s, F.least(leaves, F.col("_after") - 1), none, value), span(F.greatest(s, F.col("_prev") + lb + 1), leaves, value, none))
    spans = rows.select("query_name", F.inline(spans)).filter(F.col("t0") <= F.col("t1"))
    at = spans.select("query_name", "oldest", "newest", F.explode(F.sequence("t0", "t1", F.lit(step).cast("bigint"))).alias("_t"))
    g = at.groupBy("query_name", "_t").agg(F.max("oldest").alias("_s"), F.max("newest").alias("_e"))
    first, last = F.col("_s").cast("double"), F.col("_e").cast("double")
    growth = F.when(F.col("_s") > 0, round_half_up(F.lit(100.0) * (last - first) / first, 2))
    return g.select(
        F.lit("alert_state_memory_growth").alias("query_name"),
        F.col("query_name").alias("entity"),
        growth.alias("value"),
        F.timestamp_seconds("_t").alias("evaluated_at"),
    ).filter(F.col("value").isNotNull())


def backtest_backpressure(prog: DataFrame, lookback_minutes: int, step_seconds: int, start, end, newest: int = 5) -> DataFrame:
    """U9 for alert 2: per grid instant and stream, backpressured batches
    among the newest ``newest`` batches inside the lookback.  The window is
    per (instant, stream), so it holds one lookback of one stream."""
    from pyspark.sql import Window

    t = backtest_rows(prog, lookback_minutes, step_seconds, start, end).select(
        "query_id", "query_name", "batch_id", "_t", F.when(F.col("input_rows_per_second") > F.col("processed_rows_per_second"), 1).otherwise(0).alias("_bp")
    )
    rn = F.row_number().over(Window.partitionBy("_t", "query_id").orderBy(F.col("batch_id").desc()))
    top = t.select("*", rn.alias("_rn")).filter(F.col("_rn") <= newest)
    g = top.groupBy("_t", "query_id", "query_name").agg(F.sum("_bp").cast("double").alias("value"))
    return g.select(F.lit("alert_sustained_backpressure").alias("query_name"), F.col("query_name").alias("entity"), "value", F.timestamp_seconds("_t").alias("evaluated_at"))


def backtest_duration_spike(prog: DataFrame, lookback_minutes: int, step_seconds: int, start, end, factor: float = 3.0, history: int = 20) -> DataFrame:
    """U9 for alert 3: per grid instant, spikes against the average of the
    previous ``history`` batches inside the lookback, every one of them;
    value = unrounded factor."""
    from pyspark.sql import Window

    t = backtest_rows(prog, lookback_minutes, step_seconds, start, end).select("query_id", "query_name", "batch_id", "batch_duration_ms", "_t")
    avg = F.avg("batch_duration_ms").over(Window.partitionBy("_t", "query_id").orderBy("batch_id").rowsBetween(-history, -1))
    c = t.select("*", avg.alias("_avg")).filter((F.col("batch_duration_ms") > F.lit(factor) * F.col("_avg")) & F.col("_avg").isNotNull())
    raw = F.col("batch_duration_ms") / F.nullif(F.col("_avg"), F.lit(0.0))
    return c.select("*", raw.alias("_raw")).select(
        F.lit("alert_batch_duration_spike").alias("query_name"),
        F.concat_ws("/", "query_name", F.col("batch_id").cast("string")).alias("entity"),
        F.col("_raw").alias("value"),
        F.timestamp_seconds("_t").alias("evaluated_at"),
    )


def backtest_alert(
    name: str,
    prog: DataFrame,
    errors: DataFrame,
    sla: DataFrame,
    start,
    end,
    lookback_minutes: int | None = None,
    step_seconds: int | None = None,
    rules=RULES,
) -> DataFrame:
    """U9 in one call: replay the alert ``name`` over [start, end] on its
    own schedule (``schedule_interval_seconds`` of the rule) and lookback
    (the detector's default), and evaluate it against its rule.  Returns
    (name, entity, evaluated_at, value, fired, ...) rows."""
    rule = next(dict(zip(RULE_FIELDS, r)) for r in rules if r[0] == name)
    detector = rule["query_name"]
    lb = lookback_minutes or C.ALERT_LOOKBACK_MINUTES[detector]
    step = step_seconds or int(rule["schedule_interval_seconds"])
    if detector == "alert_sla_breach":
        ev = backtest_counts(sla.filter(F.col("sla_breach_flag")), detector, "query_name", lb, step, start, end)
    elif detector == "alert_stream_terminated":
        ev = backtest_counts(errors, detector, "query_id", lb, step, start, end)
    elif detector == "alert_state_memory_growth":
        ev = backtest_state_growth(prog, lb, step, start, end)
    elif detector == "alert_sustained_backpressure":
        ev = backtest_backpressure(prog, lb, step, start, end)
    elif detector == "alert_batch_duration_spike":
        ev = backtest_duration_spike(prog, lb, step, start, end)
    else:
        raise ValueError(detector)
    return evaluate(ev, [r for r in rules if r[0] == name])


def _rearm_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("evaluated_at", kind="mergesort")
    keep, last = [], None
    secs = pdf["evaluated_at"].astype("int64") // 10**9
    rearm = int(pdf["rearm_seconds"].iloc[0])
    for s in secs:
        ok = last is None or s - last >= rearm
        keep.append(ok)
        if ok:
            last = s
    out = pdf.assign(notified=keep)
    return out[["name", "entity", "evaluated_at", "notified"]]


def rearm(firings: DataFrame, block_rows: int | None = 1 << 16, chunk_seconds: int = 86_400) -> DataFrame:
    """Mark which firings notify, given each rule's re-arm time.

    A firing notifies when at least ``rearm_seconds`` have passed since the
    last *notifying* firing of the same (alert, entity).  A firing that comes
    ``rearm_seconds`` or more after the previous firing always notifies, so
    the sequence splits there into independent bursts; only inside a burst
    is the decision a sequential fold (``applyInPandas`` per burst).  Burst
    starts come from a one-row-back frame and a running maximum, both split
    per (alert, entity) and time chunk (``operators/frames.py``), so no step
    holds all firings of a busy alert."""
    from vigil.operators import frames

    keys = ["name", "entity"]
    f = firings.select("name", "entity", "evaluated_at", "rearm_seconds").withColumn("_s", F.unix_seconds("evaluated_at"))
    chunk = F.floor(F.col("_s") / F.lit(chunk_seconds))
    lagged = frames.rows_frame(f, keys, ["_s"], 1, lambda w: {"_prev": F.lag("_s").over(w)}, block_rows, chunk)
    starts = lagged.withColumn("_start", F.when(F.col("_prev").isNull() | (F.col("_s") - F.col("_prev") >= F.col("rearm_seconds")), F.col("_s")))
    burst = frames.max_before(starts, keys, "_s", "_start", "_before", chunk).withColumn("_burst", F.coalesce(F.col("_start"), F.col("_before")))
    schema = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("entity", T.StringType()),
            T.StructField("evaluated_at", T.TimestampType()),
            T.StructField("notified", T.BooleanType()),
        ]
    )
    return burst.select("name", "entity", "evaluated_at", "rearm_seconds", "_burst").groupBy("name", "entity", "_burst").applyInPandas(
        lambda pdf: _rearm_group(pdf.drop(columns=["_burst"])), schema
    )
