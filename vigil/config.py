"""Monitoring configuration: thresholds, clocks and tuning knobs.

Every operator takes a ``MonitorConfig`` instead of reading globals, and an
explicit ``as_of`` timestamp instead of "now", so that the same function can
serve a live dashboard, a back-test over history and a deterministic test.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
SLA_LATENCY_WARNING_MS = 30_000
SLA_LATENCY_CRITICAL_MS = 60_000
BATCH_DURATION_WARNING_MS = 30_000
BATCH_DURATION_CRITICAL_MS = 60_000
BACKPRESSURE_WARNING_BATCHES = 3
BACKPRESSURE_CRITICAL_BATCHES = 5
BACKPRESSURE_FRAME_ROWS = 5          # current batch and the 4 before it
SPIKE_FACTOR = 3.0
SPIKE_HISTORY_ROWS = 20              # previous 20 batches
STATE_GROWTH_PERCENT = 20.0
INACTIVITY_MINUTES = 10
DASHBOARD_LOOKBACK_DAYS = 7
RETENTION_DAYS = 90
WRITER_BATCH_SIZE = 50
WRITER_FLUSH_SECONDS = 10
WRITER_QUEUE_MAX = 10_000
DEFAULT_CRITICALITY = "medium"
UNNAMED_STREAM = "unnamed_stream"
# Alert lookbacks (minutes): SLA breach 10, backpressure 30, duration spike 60,
# termination 10, state growth 30.
ALERT_LOOKBACK_MINUTES = {
    "alert_sla_breach": 10,
    "alert_sustained_backpressure": 30,
    "alert_batch_duration_spike": 60,
    "alert_stream_terminated": 10,
    "alert_state_memory_growth": 30,
}
# Severity -> channel.
ESCALATION = {"warning": "slack", "critical": "pagerduty", "failure": "pagerduty"}
# Progress event message: stream name, batch id.
PROGRESS_MESSAGE = "Completed streaming update for '%s' batch %d."
# Notification text: alert name, severity, environment, description.
ALERT_MESSAGE = "Alert: %s\nSeverity: %s\nEnvironment: %s\nDescription: %s"


@dataclass(frozen=True)
class MonitorConfig:
    """Knobs shared by silver, gold and alert operators."""

    environment: str = "prod"
    workspace_id: str | None = None
    sla_ms: int = SLA_LATENCY_CRITICAL_MS
    lookback_days: int | None = DASHBOARD_LOOKBACK_DAYS
    inactivity_minutes: int = INACTIVITY_MINUTES
    as_of: datetime | None = None        # None -> current_timestamp()
    # Latency precision: "ms" (listener form) or "seconds" (pipeline form,
    # whole seconds times 1000).
    latency_precision: str = "ms"
    # Rows per block for skew-safe per-stream row frames; a stream holding
    # more rows than this is split across tasks (see operators/frames.py).
    frame_block_rows: int = 1 << 16
    # Width, in batch ids, of the pre-split used to number rows of a stream.
    batch_id_chunk: int = 1 << 16
    # Width, in seconds, of the pre-split when rows are ordered by time.
    time_chunk_seconds: int = 86_400
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "MonitorConfig":
        return replace(self, **kw)
