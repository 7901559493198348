"""Per-stream state for row-frame detectors on a live stream.

Row frames (``ROWS BETWEEN 4 PRECEDING``) are rejected on streaming
DataFrames.  ``applyInPandasWithState`` keyed by query id keeps the last
four backpressure flags of each monitored stream (bounded state, a few
bytes per stream) and emits the sustained count and status for every new
progress row, in batch-id order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigil import config as C

OUTPUT = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("sustained_count", T.LongType()),
        T.StructField("backpressure_status", T.StringType()),
    ]
)
STATE = T.StructType([T.StructField("last_batch_id", T.LongType()), T.StructField("flags", T.ArrayType(T.IntegerType()))])


def _update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Vectorised per micro-batch: the carried flags are prepended to this
    batch's flags (in batch-id order) and the 5-row sums come from one
    cumulative sum."""
    import numpy as np

    keep = C.BACKPRESSURE_FRAME_ROWS - 1
    carried = list(state.get[1]) if state.exists else []
    rows = pd.concat(list(pdfs)).sort_values("batch_id", kind="mergesort")
    flags = np.concatenate([np.asarray(carried, dtype=np.int64), rows["is_backpressured"].to_numpy(dtype=np.int64)])
    csum = np.concatenate([[0], np.cumsum(flags)])
    end = np.arange(len(carried) + 1, len(flags) + 1)
    sums = csum[end] - csum[np.maximum(end - C.BACKPRESSURE_FRAME_ROWS, 0)]
    status = np.where(sums >= C.BACKPRESSURE_CRITICAL_BATCHES, "CRITICAL", np.where(sums >= C.BACKPRESSURE_WARNING_BATCHES, "WARNING", "OK"))
    state.update((int(rows["batch_id"].iloc[-1]), [int(x) for x in flags[-keep:]]))
    yield pd.DataFrame(
        {
            "query_id": key[0],
            "query_name": rows["query_name"].to_numpy(),
            "batch_id": rows["batch_id"].to_numpy(dtype=np.int64),
            "sustained_count": sums.astype(np.int64),
            "backpressure_status": status,
        }
    )


def backpressure_stream(prog: DataFrame) -> DataFrame:
    """Streaming form of the backpressure metric over typed progress rows.

    Requires each stream's progress rows to arrive in batch-id order across
    micro-batches (as the listener appends them); rows inside one
    micro-batch are sorted by the function."""
    flagged = prog.select(
        "query_id",
        "query_name",
        "batch_id",
        F.when(F.col("input_rows_per_second") > F.col("processed_rows_per_second"), 1).otherwise(0).alias("is_backpressured"),
    )
    return flagged.groupBy("query_id").applyInPandasWithState(_update, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
