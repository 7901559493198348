"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

1. Rows become integer vectors.  They are put in order of label and of a
   Hilbert curve through the dimensions of the greatest spread, range
   partitioned, and cut into Parquet blocks of ``block_rows`` rows, each one
   row of a table: packed components beside a zone map (least and greatest
   value per dimension, least and greatest label).
2. Anchors are cut into groups the same way.
3. Plan: interval arithmetic on the zone maps bounds the score of an anchor
   with any row of a block.  Positives: an anchor reads the blocks of its
   label whose upper bound reaches the score that the lower bounds already
   guarantee for enough positives.  Negatives: the blocks whose interval meets
   one of the anchor's score windows and that are not all of its own label.
   Zone maps reach the planner in slices of a fixed size.
4. Read: only (group, block) pairs of the plan are joined with the blocks; a
   task scores one block against one group and keeps the best rows of each
   anchor and window; a window function merges them.

No pair of an anchor and a row is ever a row of a table, and no anchor's
candidates are gathered: a task holds one block and one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, bounded_batches

#: Dimensions and bits per dimension of the Hilbert curve (56 bits).
CURVE_DIMS, CURVE_BITS = 8, 7
#: Zone maps that a planning job holds at once.
ZONES = 32_768


@dataclass(frozen=True)
class MiningRules:
    anchor_every: int = 100
    positives: int = 5
    negatives: int = 10
    #: A negative's score lies between these hundredths of the positive's.
    low: int = 30
    high: int = 90
    scale: int = 256
    block_rows: int = 1024
    group_rows: int = 128


def integer_rows(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v): rows that take part, components as integers."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))


def hilbert_rank(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (Skilling's
    transposed form, all rows at once)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    rank = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            rank = (rank << 1) | ((x[i] >> b) & 1)
    return rank


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` components; shorter vectors end in zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def _spread(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(dims, the curve's dimensions, their low end, their width): figures of
    each dimension over all rows, one row per dimension on the driver."""
    flat = rows.select(F.posexplode("v").alias("d", "x"))
    per = flat.groupBy("d").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy(F.desc("s"), "d").collect()
    top = per[:CURVE_DIMS]
    mean, dev = np.array([r.m for r in top]), np.array([r.s for r in top])
    if not per:  # only empty vectors: one dimension of zeros
        return 1, np.array([0]), np.zeros(1), np.ones(1)
    return max(r.d for r in per) + 1, np.array([r.d for r in top], np.int64), mean - 2 * dev, np.maximum(4 * dev, 1e-9)


def _ordered(rows: DataFrame, spread) -> DataFrame:
    """``rows`` in order of label and curve, spread evenly by ranges; equal
    vectors are told apart by vec_id, so copies do not share a range."""
    dims, axes, low, width = spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.floor((_matrix(batch.column("v"), dims)[:, axes] - low) / width * (1 << CURVE_BITS))
            rank = hilbert_rank(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], [*batch.schema.names, "place"])

    placed = rows.mapInArrow(run, "vec_id long, label long, v array<long>, place long")
    return placed.repartitionByRange("label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id", "v")


BLOCK = "block long, n int, low binary, high binary, least long, most long, ids binary, labels binary, v binary"


def _blocks(ordered: DataFrame, dims: int, size: int) -> DataFrame:
    """Runs of ``size`` rows packed into one row each, with their zone map.
    Equal rows follow each other; one stays."""

    def pack(block: int, ids, labels, v) -> list:
        order = [x.tobytes() for x in (v.min(0), v.max(0))]
        return [block, len(ids), *order, int(labels.min()), int(labels.max()), ids.tobytes(), labels.tobytes(), _narrow(v).tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in BLOCK.split(", ")]
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dims), np.int64)]
        last = np.zeros((0, dims + 2), np.int64)
        schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("low", "high")), ("least", pa.int64()), ("most", pa.int64()), *((c, pa.binary()) for c in ("ids", "labels", "v"))])
        for batch in batches:
            if not batch.num_rows:
                continue
            new = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dims)
            rows = np.column_stack(new)
            fresh = (rows != np.concatenate([last, rows[:-1]])).any(1) if len(last) else np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
            last = rows[-1:]
            held = [np.concatenate([a, b[fresh]]) for a, b in zip(held, new)]
            out = []
            while len(held[0]) >= size:
                out.append(pack(block + len(out), *(x[:size] for x in held)))
                held = [x[size:] for x in held]
            block += len(out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], names)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip(pack(block, *held), schema)], names)

    return ordered.select("vec_id", "label", "v").mapInArrow(run, BLOCK)


def _ints(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def _narrow(v: np.ndarray) -> np.ndarray:
    """The components in the least width that holds them."""
    most = int(np.abs(v).max(initial=0))
    return v.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _vectors(value: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(value, f"i{len(value) // (n * dims)}").reshape(n, dims).astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while every sum stays below
    2**53, else in 64-bit integers."""
    most = max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0))) * max(1, a.shape[1])
    if most < 1 << 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with any vector between
    ``low`` and ``high`` of each block."""
    pos, neg = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _product(pos, low) + _product(neg, high), _product(pos, high) + _product(neg, low)


class Zones:
    """A slice of the zone maps, sorted by block."""

    def __init__(self, rows: pa.Table, dims: int):
        self.block, self.n = rows["block"].to_numpy(), rows["n"].to_numpy()
        self.low, self.high = (_ints(b"".join(rows[c].to_pylist())).reshape(-1, dims) for c in ("low", "high"))
        self.least, self.most = rows["least"].to_numpy(), rows["most"].to_numpy()


def positive_blocks(anchors: np.ndarray, labels: np.ndarray, zones: Zones, wanted: int) -> np.ndarray:
    """Which blocks each anchor has to read for its best ``wanted`` rows of
    its own label."""
    low, high = score_bounds(anchors, zones.low, zones.high)
    own = (zones.least <= labels[:, None]) & (labels[:, None] <= zones.most)
    pure = own & (zones.least == zones.most)
    # blocks of this label alone, best lower bounds first, until they hold
    # enough rows besides the anchor itself: that lower bound is guaranteed
    sure = np.where(pure, low, np.iinfo(np.int64).min)
    order = np.argsort(sure, axis=1)[:, ::-1]
    rows = np.take_along_axis(np.where(pure, zones.n, 0), order, 1).cumsum(1)
    enough = (rows > wanted).argmax(1)
    reached = rows[:, -1] > wanted
    floor = np.where(reached, np.take_along_axis(sure, order, 1)[np.arange(len(anchors)), enough], np.iinfo(np.int64).min)
    return own & (high >= floor[:, None])


def negative_blocks(anchors: np.ndarray, labels: np.ndarray, lows: np.ndarray, highs: np.ndarray, zones: Zones) -> np.ndarray:
    """Which blocks may hold a row of another label in one of the windows
    (one column per positive; an empty window has its low above its high)."""
    low, high = score_bounds(anchors, zones.low, zones.high)
    other = ~((zones.least == labels[:, None]) & (labels[:, None] == zones.most))
    meets = np.zeros(low.shape, bool)
    for k in range(lows.shape[1]):
        lo, hi = lows[:, k, None], highs[:, k, None]
        meets |= (lo <= hi) & (high >= lo) & (low <= hi)
    return other & meets


def _plan(groups: DataFrame, blocks: DataFrame, dims: int, wanted, scratch: Scratch) -> DataFrame:
    """(grp, blk, mask): the blocks that a group has to read, with a byte per
    anchor.  ``wanted(row, zones)`` says so for the anchors of a group row.
    The zone maps are broadcast in slices of at most ``ZONES`` blocks, one
    planning job per slice."""
    spark = groups.sparkSession
    maps = blocks.select("block", "n", "low", "high", "least", "most")
    bounds = _slices(maps)
    plans = []
    for lo, hi in bounds:
        part = maps.where((F.col("block") >= lo) & (F.col("block") <= hi)).toArrow()
        zones = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], zones=zones) -> Iterator[pa.RecordBatch]:
            z = Zones(zones.value, dims)
            for batch in batches:
                for row in batch.to_pylist():
                    mask = wanted(row, z) if len(z.n) else np.zeros((row["n"], 0), bool)
                    at = np.flatnonzero(mask.any(0))
                    if len(at):
                        masks = pa.array([mask[:, i].tobytes() for i in at], pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["block"])), pa.array(z.block[at]), masks], ["grp", "blk", "mask"])

        plans.append(scratch.save(groups.mapInArrow(run, "grp long, blk long, mask binary"), "plan"))
    out = plans[0]
    for p in plans[1:]:
        out = out.unionAll(p)
    return out


def _slices(maps: DataFrame) -> list[tuple[int, int]]:
    """Ranges of block numbers of at most ``ZONES`` blocks each: blocks are
    numbered in runs, so the ranges are cut from the counts of the runs."""
    runs = maps.groupBy(F.shiftright("block", 40).alias("r")).agg(F.min("block").alias("lo"), F.max("block").alias("hi")).orderBy("r").collect()
    out: list[tuple[int, int]] = []
    held = 0
    for r in runs:
        for lo in range(r.lo, r.hi + 1, ZONES):
            hi = min(lo + ZONES - 1, r.hi)
            if out and held + hi - lo + 1 <= ZONES:
                out[-1], held = (out[-1][0], hi), held + hi - lo + 1
            else:
                out.append((lo, hi))
                held = hi - lo + 1
    return out or [(0, -1)]


def _read(plan: DataFrame, groups: DataFrame, blocks: DataFrame, extra: list[str]) -> DataFrame:
    """The planned pairs with the group's and the block's contents."""
    g = groups.select(F.col("block").alias("grp"), *[F.col(c).alias(f"a_{c}") for c in ["ids", "labels", "v", *extra]])
    b = blocks.select(F.col("block").alias("blk"), "ids", "labels", "v")
    return plan.join(g, "grp").join(b, "blk")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` by score (descending), then id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


HITS = "grp long, at int, anchor_id long, window int, id long, score long"


def _scored(pairs: DataFrame, dims: int, keep: int, picks) -> DataFrame:
    """The best rows of each anchor and window in every planned pair.
    ``picks(row, a, scores, same, other)`` yields (window, mask of the rows in
    it) for anchor ``a`` of a pair; ``same`` marks the rows of its label,
    ``other`` those that are not the anchor's own row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, labels, a_ids, a_labels = (_ints(row[c]) for c in ("ids", "labels", "a_ids", "a_labels"))
                v, a_v = _vectors(row["v"], len(ids), dims), _vectors(row["a_v"], len(a_ids), dims)
                asked = np.flatnonzero(np.frombuffer(row["mask"], bool))
                out = []
                for a, scores in zip(asked.tolist(), _product(a_v[asked], v)):
                    same, other = labels == a_labels[a], ids != a_ids[a]
                    for k in np.flatnonzero(same & ~other).tolist():
                        other[k] = (v[k] != a_v[a]).any()
                    for window, there in picks(row, a, scores, same, other):
                        at = np.flatnonzero(there)
                        at = at[_best(scores[at], ids[at], keep)]
                        out.append((np.full(len(at), a), np.full(len(at), a_ids[a]), np.full(len(at), window), ids[at], scores[at]))
                if out:
                    at, anchor, window, near, score = (np.concatenate(c) for c in zip(*out))
                    cols = [pa.array(np.full(len(at), row["grp"])), pa.array(at, pa.int32()), pa.array(anchor), pa.array(window, pa.int32()), pa.array(near), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(cols, ["grp", "at", "anchor_id", "window", "id", "score"])

    return pairs.mapInArrow(run, HITS)


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of every anchor and window, ranked from 1."""
    order = Window.partitionBy("grp", "at", "window").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, rules: MiningRules = MiningRules()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) from ``rows`` (vec_id, label, embedding).

    Anchors are the rows whose vec_id is divisible by ``anchor_every``; their
    positives the first other rows of their label; negatives the first rows of other labels whose score lies in the positive's window
    (``low`` to ``high`` hundredths of its score; none for a positive score
    below zero).  Score: integer inner product, a shorter vector ending in
    zeros; ties by smaller vec_id.

    Rows without vec_id, label or vector, or with a null or non-finite
    component, take no part; equal rows count once; rows that share a vec_id
    and differ are rows (and anchors) of their own; an anchor with fewer rows
    has fewer results; other columns are ignored; an empty table gives an
    empty table.  Scores outside 64 bits wrap."""
    spark = rows.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "hard-negatives")
    rows = scratch.save(integer_rows(rows, rules.scale), "rows")
    spread = _spread(rows)
    dims = spread[0]
    blocks = scratch.save(_blocks(_ordered(rows, spread), dims, rules.block_rows), "blocks")
    anchors = rows.where(F.col("vec_id") % rules.anchor_every == 0)
    groups = scratch.save(_blocks(_ordered(anchors, spread), dims, rules.group_rows), "groups")

    def positives_wanted(row, zones):
        return positive_blocks(_vectors(row["v"], row["n"], dims), _ints(row["labels"]), zones, rules.positives)

    def positives(row, a, scores, same, other):
        yield 0, same & other

    plan = _plan(groups, blocks, dims, positives_wanted, scratch)
    hits = _scored(_read(plan, groups, blocks, []), dims, rules.positives, positives)
    best = _first(hits, rules.positives).select("grp", "at", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = scratch.save(best, "positives")

    # the windows of a group's anchors go to the group
    entry = F.struct("at", "window", "positive_score")
    windows = best.groupBy(F.col("grp").alias("_grp")).agg(F.collect_list(entry).alias("windows"))
    groups = scratch.save(groups.join(windows, F.col("block") == F.col("_grp")).drop("_grp"), "windows")

    def window_bounds(n: int, windows) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.ones((n, rules.positives), np.int64), np.zeros((n, rules.positives), np.int64)
        for w in windows:
            at = w["at"], w["window"] - 1
            low[at], high[at] = -(-rules.low * w["positive_score"] // 100), rules.high * w["positive_score"] // 100
        return low, high

    def negatives_wanted(row, zones):
        return negative_blocks(_vectors(row["v"], row["n"], dims), _ints(row["labels"]), *window_bounds(row["n"], row["windows"]), zones)

    def negatives(row, a, scores, same, other):
        if "bounds" not in row:
            row["bounds"] = window_bounds(len(row["a_ids"]) // 8, row["a_windows"])
        low, high = row["bounds"]
        for k in range(rules.positives):
            if low[a, k] <= high[a, k]:
                yield k + 1, ~same & (scores >= low[a, k]) & (scores <= high[a, k])

    plan = _plan(groups, blocks, dims, negatives_wanted, scratch)
    hits = _scored(_read(plan, groups, blocks, ["windows"]), dims, rules.negatives, negatives)
    found = _first(hits, rules.negatives)
    found = found.select("grp", "at", "anchor_id", "window", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(best, ["grp", "at", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
