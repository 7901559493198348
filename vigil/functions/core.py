"""Scalar column helpers.  All return built-in Column expressions, so they stay
inside whole-stage code generation; none of them is a Python UDF."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import config as C

# Fixed value: characters kept by the name sanitiser (everything else -> "_").
NAME_UNSAFE_PATTERN = r"[^a-zA-Z0-9_\-.]"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, n: int) -> Column:
    """ROUND(x, n) of a DOUBLE, made engine independent.

    The value is first fixed to 6 decimals, then rounded half-up, so that an
    average whose last binary digit differs between engines rounds the same.
    Values of 10^12 or more (and NaN) do not fit those decimals and are
    rounded as doubles.
    """
    x = col_(c).cast("double")
    return F.when(F.abs(x) < 1e12, F.round(x.cast("decimal(18,6)"), n).cast("double")).otherwise(F.round(x, n))


def sanitize_name(c: str | Column) -> Column:
    """Stream name normalisation: trim, unsafe characters to ``_``, lower
    case; null or blank names become ``unnamed_stream``."""
    trimmed = F.regexp_replace(col_(c), r"^\s+|\s+$", "")
    cleaned = F.lower(F.regexp_replace(trimmed, NAME_UNSAFE_PATTERN, "_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(C.UNNAMED_STREAM))


def iso_timestamp(c: str | Column) -> Column:
    """ISO-8601 text (``...T...Z``) -> TIMESTAMP; malformed text -> NULL."""
    return F.try_to_timestamp(col_(c))


def ms_between(later: str | Column, earlier: str | Column) -> Column:
    """Milliseconds from ``earlier`` to ``later`` (negative when reversed)."""
    return F.unix_millis(col_(later)) - F.unix_millis(col_(earlier))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    return F.unix_timestamp(col_(later)) - F.unix_timestamp(col_(earlier))


def fold_sum(arr: str | Column, field: str) -> Column:
    """Sum of one field over an array of structs, null fields counted as 0.

    A null array stays null, an empty array gives 0."""
    return F.aggregate(col_(arr), F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(x[field], F.lit(0).cast("bigint")))


def null_safe_gt(a: str | Column, b: str | Column | float) -> Column:
    """``a > b`` where a NULL comparison counts as false."""
    rhs = b if isinstance(b, Column) else F.lit(b) if not isinstance(b, str) else F.col(b)
    return F.coalesce(col_(a) > rhs, F.lit(False))


def severity_tier(c: str | Column, warning: float, critical: float) -> Column:
    """Two-tier classification: CRITICAL above ``critical``, WARNING above
    ``warning``, OK otherwise, NULL for a null value."""
    v = col_(c)
    return F.when(v.isNull(), F.lit(None).cast("string")).when(v > critical, "CRITICAL").when(v > warning, "WARNING").otherwise("OK")


def ts_literal(t: datetime | str) -> Column:
    """A TIMESTAMP literal read in the session time zone (pinned to UTC)."""
    s = t if isinstance(t, str) else t.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(s))


def as_of_col(as_of: datetime | str | None) -> Column:
    """The evaluation clock: a fixed literal, or ``current_timestamp()``."""
    return F.current_timestamp() if as_of is None else ts_literal(as_of)


def lookback_days_filter(ts: str | Column, as_of: datetime | str | None, days: int | None) -> Column:
    """Whole-day lookback: ``CAST(ts AS DATE) >= as_of_date - days`` and no
    rows after the clock.  ``days=None`` keeps all history up to the clock."""
    t = col_(ts)
    now = as_of_col(as_of)
    cond = t <= now
    if days is not None:
        # CAST(ts AS DATE) >= d  is rewritten by Catalyst into a pushable
        # range predicate on ts.
        cond = cond & (F.to_date(t) >= F.date_sub(F.to_date(now), days))
    return cond


def lookback_interval_filter(ts: str | Column, as_of: datetime | str | None, minutes: int) -> Column:
    """Sub-day lookback: ``as_of - minutes <= ts <= as_of``."""
    t = col_(ts)
    now = as_of_col(as_of)
    return (t >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")) & (t <= now)


def partition_days_filter(as_of: datetime | str | None, days: int | None = None, minutes: int | None = None, part: str = "event_date") -> Column:
    """The ``event_date`` range implied by a lookback, for tables stored by
    day: a predicate on the partition column lets the scan skip whole days
    (the timestamp predicate alone cannot prune directories)."""
    now = as_of_col(as_of)
    cond = F.col(part) <= F.to_date(now)
    if days is not None:
        cond = cond & (F.col(part) >= F.date_sub(F.to_date(now), days))
    if minutes is not None:
        cond = cond & (F.col(part) >= F.to_date(now - F.expr(f"INTERVAL {int(minutes)} MINUTES")))
    return cond


def to_ntz(df):
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ (UTC wall clock) for output to
    engines without time zones."""
    from pyspark.sql.types import TimestampType

    return df.select(
        [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name) for f in df.schema.fields]
    )


def event_id(*parts: str | Column) -> Column:
    """Deterministic event id (replays of one batch get the same id)."""
    return F.sha2(F.concat_ws("|", *[col_(p).cast("string") for p in parts]), 256)
