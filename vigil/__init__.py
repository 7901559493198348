"""vigil: streaming-query observability on Spark.

Progress events of Structured Streaming queries are kept as an append-only
event log (bronze), parsed into typed metric tables (silver) and answered by
dashboard metrics and alert detectors (gold).  Everything is a
``DataFrame -> DataFrame`` function over the public Spark API.
"""

from vigil.config import MonitorConfig

__all__ = ["MonitorConfig"]
