"""Build the bronze -> silver chain from the given tables, lazily.

A ``Context`` holds DataFrames only (no action runs here); every check
composes them into its own plan, so Catalyst sees the whole chain from the
parquet scan to the result and prunes columns / pushes filters through it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import MonitorConfig
from vigil.operators import infra, silver
from vigil.sources import progress_log

# ---------------------------------------------------------------------------
# Fixed check parameters (clock anchors and thresholds for the given data).
# ---------------------------------------------------------------------------
AS_OF_END = "2024-01-31 00:00:00"
AS_OF_OVERVIEW = "2024-01-10 21:09:00"
TEST_SLA_MS = 1_800_000

BASE = MonitorConfig(environment="prod", sla_ms=TEST_SLA_MS, as_of=AS_OF_END, lookback_days=7)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: MonitorConfig = BASE):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, cfg: MonitorConfig = BASE) -> "Context":
        """A context shared by the checks of one session: its DataFrames are
        logical plans only (no data is cached), built once instead of on every
        call.  The inputs are read-only tables; a fresh ``Context`` re-lists
        them."""
        cache = getattr(spark, "_vigil_contexts", None)
        if cache is None:
            cache = {}
            spark._vigil_contexts = cache
        key = (sf_dir, repr(cfg))
        if key not in cache:
            cache[key] = cls(spark, sf_dir, cfg)
        return cache[key]

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def bronze(self) -> DataFrame:
        return progress_log.event_log_from_events(self.events)

    @cached_property
    def tags(self) -> DataFrame:
        """Business tags per stream, derived from the stream names in the
        data (one row per stream)."""
        t = self.events.select("event_type").distinct()
        et = F.col("event_type")
        return t.select(
            F.concat(F.lit("q-"), et).alias("query_id"),
            F.when(et.isin("click", "view"), "web").when(et == "purchase", "commerce").otherwise("platform").alias("domain"),
            F.concat(F.lit("team-"), et).alias("owner"),
            F.when(et == "purchase", "high").when(et == "error", F.lit(None)).otherwise("low").alias("criticality"),
        )

    @cached_property
    def tag_history(self) -> DataFrame:
        """Settings of tags over time: every event sets the tags of its stream
        from its own time on, with the user's team as owner."""
        v = F.col("value")
        return self.events.select(
            F.concat(F.lit("q-"), F.col("event_type")).alias("query_id"),
            F.col("ts").cast("timestamp").alias("valid_from"),
            F.col("event_id").alias("version"),
            F.when(v < 10, "web").when(v < 30, "commerce").otherwise("platform").alias("domain"),
            F.concat(F.lit("team-"), F.col("user_id").cast("string")).alias("owner"),
            F.when(v < 5, F.lit(None)).when(v < 20, "low").otherwise("high").alias("criticality"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return silver.streaming_metrics(self.bronze, self.cfg)

    @cached_property
    def prog(self) -> DataFrame:
        return silver.progress(self.metrics, self.cfg)

    @cached_property
    def errors_raw(self) -> DataFrame:
        return silver.stream_errors(self.bronze, self.cfg)

    @cached_property
    def errors(self) -> DataFrame:
        return silver.with_restart_counts(self.errors_raw, self.cfg)

    @cached_property
    def sla(self) -> DataFrame:
        return silver.sla_latency_metrics(self.prog, self.cfg)

    @cached_property
    def dq(self) -> DataFrame:
        return silver.data_quality_metrics(self.prog, self.cfg)

    @cached_property
    def infra(self) -> DataFrame:
        samples = progress_log.cluster_samples(self.events, self.cfg.environment)
        return infra.autoscale_events(samples, self.cfg, order=("timestamp", "sample_id"))
