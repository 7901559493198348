"""As-of joins: the newest right row at or before each left row (J3 in time).

Both sides are united and put in order per key; the last right value before a
left row is a running maximum over (time, version, values).  ``max_before``
splits it by time chunks, so no task holds all rows of one key, and nothing is
paired and then thrown away as in a range join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import config as C
from vigil.config import MonitorConfig
from vigil.operators import frames


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    version: str,
    chunk_seconds: int = 86_400,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the newest ``right`` row of
    its keys whose ``right_ts`` is not after ``left_ts``; null where there is
    none, or where a key or ``left_ts`` is null.  Of right rows at one time
    the largest ``version`` counts.  Left columns named like a value are
    replaced by it."""
    keep = [c for c in left.columns if c not in values]
    value = F.struct(F.col(right_ts).alias("at"), F.col(version).alias("version"), F.struct(*values).alias("values"))
    r = right.filter(F.col(right_ts).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(right_ts).alias("_at"), F.lit(0).alias("_side"), value.alias("_value")
    )
    for i in range(len(keys)):
        r = r.filter(F.col(f"_k{i}").isNotNull())
    l = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(left_ts).alias("_at"),
        F.lit(1).alias("_side"),
        F.struct(*keep).alias("_row"),
    )
    u = l.unionByName(r, allowMissingColumns=True).withColumn("_order", F.struct("_at", "_side"))
    chunk = F.floor(F.unix_seconds("_at") / F.lit(chunk_seconds))
    found = frames.max_before(u, [f"_k{i}" for i in range(len(keys))], "_order", "_value", "_found", chunk)
    return found.filter(F.col("_side") == 1).select("_row.*", *[F.col("_found.values")[v].alias(v) for v in values])


TAGS = ("domain", "owner", "criticality")


def with_tags_as_of(df: DataFrame, history: DataFrame, cfg: MonitorConfig, ts: str = "timestamp") -> DataFrame:
    """J3 with validity: each row of a stream gets the tags that were in force
    at its time.  ``history`` has one row per setting of tags (``query_id``,
    ``valid_from``, ``version``, the tags).  Before the first setting, and for
    a tag set to null, the defaults of untagged streams hold."""
    tagged = as_of(df, history, ["query_id"], ts, "valid_from", TAGS, "version", cfg.time_chunk_seconds)
    default = {"domain": "", "owner": "", "criticality": C.DEFAULT_CRITICALITY}
    return tagged.withColumns({t: F.coalesce(F.col(t), F.lit(default[t])) for t in TAGS})
