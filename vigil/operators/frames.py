"""Skew-safe per-key row frames.

A plain ``Window.partitionBy(query_id).orderBy(batch_id)`` sends every row of
one stream to one task.  A busy stream (or a single long-lived stream that
holds a third of the log) then becomes a straggler.  The metrics here only
ever look a bounded number of rows back (5 for backpressure, 20 for spikes,
1 for growth), so the rows of one key can be cut into blocks and each block
evaluated independently, provided it also sees the few rows that precede
it:

1. ``dense_index``: position of every row inside its key, computed as a
   local ``row_number`` inside (key, coarse chunk of the ordering value)
   plus the row count of the key's earlier chunks (a small per-chunk
   aggregate, partially aggregated before its shuffle).  No step holds more
   than one chunk of one key.

Cost against the unsplit window: the rows are shuffled twice (by (key,
chunk), then by (key, block)) instead of once, plus one narrow scan of the
key columns for the chunk counts.  That is the price of never putting a
stream's rows into one task.
2. ``rows_frame``: block = index // block_rows.  The last ``preceding`` rows
   of each block are also emitted (``explode``, one pass), as halo rows, into
   the next block; windows run over (key, block) ordered by index; halo rows
   are dropped after.

The result equals the unsplit window exactly (tests compare both).  When a
key fits in one block the halo is empty and only the extra index pass is
paid.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

_IDX = "_frame_idx"
_CHUNK = "_frame_chunk"
_BLOCK = "_frame_block"
_HALO = "_frame_halo"


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def dense_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chunk: Column | None = None, name: str = _IDX) -> DataFrame:
    """0-based position of each row within its key, by ``order``.

    ``chunk`` is a coarse, order-compatible bucket of the ordering value
    (e.g. ``batch_id div 65536``).  When given, no window ever spans more
    than one chunk of one key.
    """
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(name, F.row_number().over(w) - 1)
    d = df.withColumn(_CHUNK, chunk)
    # Local position: one shuffle of the rows by (key, chunk).  Chunk sizes:
    # a count with partial aggregation (each task ships one row per chunk it
    # holds), read from a scan pruned to the key and ordering columns.
    local = F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*_cols(order))) - 1
    counts = d.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    o = counts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col(_CHUNK).alias("_o_chunk"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_off"),
    )
    cond = [d[k].eqNullSafe(o[f"_o_{k}"]) for k in keys] + [d[_CHUNK].eqNullSafe(o["_o_chunk"])]
    return (
        d.withColumn("_local", local)
        .join(o, cond, "inner")
        .withColumn(name, F.col("_off") + F.col("_local"))
        .drop("_local", "_off", "_o_chunk", _CHUNK, *[f"_o_{k}" for k in keys])
    )


def rows_frame(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    preceding: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    block_rows: int | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Add the window columns returned by ``build(w)``.

    ``w`` is partitioned by the key (and block) and ordered by the row
    position; ``build`` may use any frame that looks at most ``preceding``
    rows back and none forward (``rowsBetween(-k, 0)``, ``lag``).  With
    ``block_rows=None`` the plain, unsplit window is used.
    """
    if block_rows is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.select("*", *[c.alias(n) for n, c in build(w).items()])
    if preceding >= block_rows:
        raise ValueError("block_rows must exceed the frame length")
    idx = dense_index(df, keys, order, chunk)
    own = F.floor(F.col(_IDX) / F.lit(block_rows))
    tail = (F.col(_IDX) % F.lit(block_rows)) >= F.lit(block_rows - preceding)
    # One pass: every row goes to its own block; the last ``preceding`` rows
    # of a block also go, flagged as halo, to the next block.
    targets = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own)) if preceding > 0 else F.array(own)
    u = idx.withColumn(_BLOCK, F.explode(targets)).withColumn(_HALO, F.col(_BLOCK) != own)
    w = Window.partitionBy(*keys, _BLOCK).orderBy(_IDX)
    out = u.select("*", *[c.alias(n) for n, c in build(w).items()])
    return out.filter(~F.col(_HALO)).drop(_BLOCK, _HALO, _IDX)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, before: str, after: str, block_rows: int | None, chunk: Column | None = None) -> DataFrame:
    """Add ``value`` of the key's previous and next row (null at the ends).

    As ``rows_frame``, with halo rows on both sides: the first row of a block
    also goes to the block before, the last one to the block after."""
    if block_rows is None:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.select("*", F.lag(value).over(w).alias(before), F.lead(value).over(w).alias(after))
    idx = dense_index(df, keys, order, chunk)
    own, place = F.floor(F.col(_IDX) / F.lit(block_rows)), F.col(_IDX) % F.lit(block_rows)
    targets = F.array_compact(F.array(own, F.when((place == 0) & (own > 0), own - 1), F.when(place == block_rows - 1, own + 1)))
    u = idx.withColumn(_BLOCK, F.explode(targets)).withColumn(_HALO, F.col(_BLOCK) != own)
    w = Window.partitionBy(*keys, _BLOCK).orderBy(_IDX)
    out = u.select("*", F.lag(value).over(w).alias(before), F.lead(value).over(w).alias(after))
    return out.filter(~F.col(_HALO)).drop(_BLOCK, _HALO, _IDX)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str, chunk: Column) -> DataFrame:
    """Sum of ``value`` over the key's rows up to each row (by ``order``).

    The sum of earlier chunks comes from a per-chunk aggregate (one row per
    chunk), the rest from a window inside the chunk, so no window spans more
    than one chunk of a key."""
    d = df.withColumn(_CHUNK, chunk)
    upto, before = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    local = F.sum(value).over(Window.partitionBy(*keys, _CHUNK).orderBy(*_cols(order)).rowsBetween(*upto))
    sums = d.groupBy(*keys, _CHUNK).agg(F.sum(value).alias("_csum"))
    earlier = sums.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col(_CHUNK).alias("_o_chunk"),
        F.coalesce(F.sum("_csum").over(Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(*before)), F.lit(0)).alias("_off"),
    )
    cond = [d[k].eqNullSafe(earlier[f"_o_{k}"]) for k in keys] + [d[_CHUNK].eqNullSafe(earlier["_o_chunk"])]
    return d.withColumn("_local", local).join(earlier, cond, "inner").withColumn(name, F.col("_off") + F.col("_local")).drop("_local", "_off", "_o_chunk", _CHUNK, *[f"_o_{k}" for k in keys])


def max_before(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, chunk: Column | None = None) -> DataFrame:
    """Maximum of ``value`` over the key's rows strictly before each row (by
    ``order``); null for the first row.

    With ``chunk``: the maximum of earlier chunks comes from a per-chunk
    aggregate (one row per chunk), the rest from a window inside the chunk,
    so no window spans more than one chunk of a key."""
    before = Window.unboundedPreceding
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(before, -1)
        return df.withColumn(name, F.max(value).over(w))
    d = df.withColumn(_CHUNK, chunk)
    local = F.max(value).over(Window.partitionBy(*keys, _CHUNK).orderBy(order).rowsBetween(before, -1))
    cm = d.groupBy(*keys, _CHUNK).agg(F.max(value).alias("_cmax"))
    earlier = cm.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col(_CHUNK).alias("_o_chunk"),
        F.max("_cmax").over(Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(before, -1)).alias("_emax"),
    )
    cond = [d[k].eqNullSafe(earlier[f"_o_{k}"]) for k in keys] + [d[_CHUNK].eqNullSafe(earlier["_o_chunk"])]
    return (
        d.withColumn("_lmax", local)
        .join(earlier, cond, "inner")
        .withColumn(name, F.greatest(F.col("_lmax"), F.col("_emax")))
        .drop("_lmax", "_emax", "_o_chunk", _CHUNK, *[f"_o_{k}" for k in keys])
    )
