"""SimHash near-duplicates through a Gray-order hierarchical index.

1. Fingerprints: per document, 64-bit XXH64 (seed 42) of every 3-word
   shingle; a fingerprint bit is 1 if set in over half of the hashes.
2. Equal fingerprints collapse (partial aggregation) before any search.
3. The index.  Upper nodes are (rotation, value of a 16-bit block): two
   fingerprints within three bits agree in at least one of four blocks, so
   every link lies below one of those nodes.  Below a node the fingerprints
   are sorted by Gray rank; consecutive runs form leaves, runs of leaves form
   inner nodes, and each node keeps the bit pattern that all its members
   share with the mask of those bits.
4. The search walks pairs of nodes from the top.  The differences of two
   patterns on their common mask accumulate down the tree; a pair of groups
   is pruned as a whole once they exceed the bound, and accepted as a whole
   if even all unshared bits could not exceed it.
5. Links found below a node go through a local union-find, so a group of n
   near copies emits n - 1 links, not n * n.  The distributed union-find joins
   the rest.

A node with more than ``hot_rows`` members is first split again by four
blocks of its remaining 48 bits (same pigeonhole argument, same links).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import Scratch, bounded_batches, broadcast_if_small, fresh
from vigil.llm.components import connected_components

LEAF = 64
FANOUT = 8
PAIRS_AT_ONCE = 1 << 20
#: Rows of representatives (three longs each) up to which they are broadcast.
BROADCAST_ROWS = 1_000_000


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text (null and wordless texts: 0)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    counts, n = np.zeros(64, np.int64), len(starts)
    stops = ends[shingle - 1 :].tolist()
    for at in range(0, n, 65536):
        hashes = np.array([h(joined[s:e], 42) for s, e in zip(starts[at : at + 65536], stops[at : at + 65536])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > n))


def text_id(text: Column) -> Column:
    """Tells the texts of a repeated doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, text_id): one row per input row, ``fp`` the fingerprint as
    a signed 64-bit long, ``text_id`` the XXH64 of the text (null: empty)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), b.column(2)], ["doc_id", "fp", "text_id"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_id(text).alias("text_id")).mapInArrow(run, "doc_id long, fp long, text_id long")


# ----------------------------------------------------------------- local index


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def local_components(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the labelled ends of links (a, b) in place; labels stay the
    smallest index of their set."""
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


class GrayIndex:
    """Hierarchical index over distinct fingerprints in Gray order.

    ``levels[0]`` are leaves of ``LEAF`` consecutive codes; each higher level
    joins ``FANOUT`` nodes.  A node has the common bits of its members
    (``pattern``, zero outside ``mask``)."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        ones, zeros = self._reduce(self.fps, ~self.fps, LEAF)
        self.levels = [(ones, zeros)]
        while len(ones) > 1:
            ones, zeros = self._reduce(ones, zeros, FANOUT)
            self.levels.append((ones, zeros))

    @staticmethod
    def _reduce(ones: np.ndarray, zeros: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(0, len(ones), width)
        return np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)

    def components(self, max_bits: int) -> np.ndarray:
        """For each code of ``self.fps`` the smallest index of its component
        under links of at most ``max_bits`` differing bits."""
        labels = np.arange(len(self.fps))
        stack = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIRS_AT_ONCE >> 6:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            ones, zeros = self.levels[level]
            apart = np.bitwise_count((ones[a] & zeros[b]) | (zeros[a] & ones[b]))
            free = np.bitwise_count(~((ones[a] & ones[b]) | (zeros[a] & zeros[b]) | (ones[a] & zeros[b]) | (zeros[a] & ones[b])))
            keep = apart <= max_bits  # groups that differ more are pruned whole
            whole = keep & (apart + free <= max_bits)  # all members link
            width = LEAF * FANOUT**level
            for x, y in zip(a[whole], b[whole]):
                for node in {int(x), int(y)}:
                    run = np.arange(node * width, min((node + 1) * width, len(self.fps)))
                    local_components(labels, run[1:], run[:-1])
                local_components(labels, np.array([x * width]), np.array([y * width]))
            keep &= ~whole
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            step = FANOUT if level else LEAF
            below = len(self.levels[level - 1][0]) if level else len(self.fps)
            grid = np.arange(step)
            if level == 0:
                for lo in range(0, len(a), PAIRS_AT_ONCE // (LEAF * LEAF)):
                    self._leaves(labels, a[lo : lo + PAIRS_AT_ONCE // (LEAF * LEAF)], b[lo : lo + PAIRS_AT_ONCE // (LEAF * LEAF)], max_bits)
                continue
            ca = (a[:, None, None] * step + grid[None, :, None]) + 0 * grid[None, None, :]
            cb = (b[:, None, None] * step + grid[None, None, :]) + 0 * grid[None, :, None]
            ca, cb = ca.ravel(), cb.ravel()
            ok = (ca <= cb) & (ca < below) & (cb < below)
            stack.append((level - 1, ca[ok], cb[ok]))
        return labels

    def _leaves(self, labels: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> None:
        grid, n = np.arange(LEAF), len(self.fps)
        ia = np.minimum(a[:, None] * LEAF + grid, n - 1)
        ib = np.minimum(b[:, None] * LEAF + grid, n - 1)
        near = np.bitwise_count(self.fps[ia][:, :, None] ^ self.fps[ib][:, None, :]) <= max_bits
        p, i, j = np.nonzero(near)
        local_components(labels, ia[p, i], ib[p, j])


def _star_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (fp, smallest index of its component) for each run of one key."""
    cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    sizes = np.diff(cut)
    if not len(keys):
        return
    small = np.repeat((sizes > 1) & (sizes <= LEAF), sizes)
    # runs within one leaf are compared member by member, all runs at once
    for d in range(1, int(sizes[sizes <= LEAF].max(initial=1))):
        i = np.flatnonzero(small[:-d] & (keys[d:] == keys[:-d])) if d < len(keys) else np.zeros(0, int)
        near = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= max_bits]
        if len(near):
            yield fps[near + d], fps[near]
    for k in np.flatnonzero(sizes > LEAF):
        index = GrayIndex(np.unique(fps[cut[k] : cut[k + 1]]))
        labels = index.components(max_bits)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        if len(linked):
            yield index.fps[linked], index.fps[labels[linked]]


def links(fps: DataFrame, max_bits: int = 3, hot_rows: int = 100_000) -> DataFrame:
    """(u, v): links whose closure equals the closure of all pairs of
    fingerprints (column ``fp``, distinct) within ``max_bits`` bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("four blocks find every link of at most 3 bits")
    blocks = [F.shiftrightunsigned("fp", 16 * r).bitwiseAND(F.lit(0xFFFF)) for r in range(4)]
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), b.alias("v")) for r, b in enumerate(blocks)])).alias("k"))
    keyed = keyed.select("fp", (F.col("k.r") * 65536 + F.col("k.v")).alias("key"))
    hot = keyed.groupBy(F.col("key").alias("_hot")).count().where(F.col("count") > hot_rows).select("_hot")
    keyed = keyed.join(hot, keyed["key"] == hot["_hot"], "left")
    # remaining 48 bits, rotated to the low end, in four blocks of 12
    rest = F.when(F.col("key") < 65536, F.shiftrightunsigned("fp", 16))
    for r in (1, 2, 3):
        low = F.col("fp").bitwiseAND(F.lit((1 << (16 * r)) - 1))
        high = F.lit(0).cast("long") if r == 3 else F.shiftleft(F.shiftrightunsigned("fp", 16 * (r + 1)), 16 * r)
        rest = rest.when((F.col("key") >= 65536 * r) & (F.col("key") < 65536 * (r + 1)), low.bitwiseOR(high))
    subs = F.array(*[F.lit(1 + s) * 4096 + F.shiftrightunsigned(rest, 12 * s).bitwiseAND(F.lit(0xFFF)) for s in range(4)])
    keyed = keyed.select("fp", "key", F.explode(F.when(F.col("_hot").isNull(), F.array(F.lit(0).cast("long"))).otherwise(subs)).alias("sub"))
    keyed = keyed.select("fp", (F.col("key") * 65536 + F.col("sub")).alias("key")).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(k, f):
            for u, v in _star_links(k, f, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        ks, fs, limit = [], [], 200_000
        for b in batches:
            ks.append(b.column(1).to_numpy(zero_copy_only=False))
            fs.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, ks)) < limit:
                continue
            k, f = np.concatenate(ks), np.concatenate(fs)
            last = np.searchsorted(k, k[-1])  # the last run may go on in the next batch
            yield from emit(k[:last], f[:last])
            ks, fs, limit = [k[last:]], [f[last:]], max(200_000, 2 * (len(k) - last))
        if ks:
            yield from emit(np.concatenate(ks), np.concatenate(fs))

    return keyed.mapInArrow(run, "u long, v long")


# -------------------------------------------------------------------- operator


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, hot_rows: int = 100_000) -> DataFrame:
    """(doc_id, fp, component_id, component, text_id): one row per input row.

    ``component_id`` is the smallest doc_id whose fingerprint is reachable by
    links of at most ``max_bits`` differing bits, the document's own included;
    ``component`` tells components apart whose doc_ids repeat (its smallest
    fingerprint as a signed long), ``text_id`` the texts of one doc_id.
    Null and wordless texts have fingerprint zero and link like any other;
    repeated rows are returned as often as given; a null doc_id has no rank
    (a component of null ids only has a null component_id); columns other
    than doc_id and text are ignored; an empty table gives an empty table.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    fps = scratch.save(fingerprints(docs, shingle), "fps")
    groups = scratch.save(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    cc = scratch.save(connected_components(links(groups.select("fp"), max_bits, hot_rows), scratch), "components")
    least = cc.join(groups, cc["node"] == groups["fp"]).groupBy("component").agg(F.min("least").alias("component_id"))
    linked = cc.join(least, "component").select(F.col("node").alias("_fp"), "component", "component_id")
    by_fp = groups.join(linked, groups["fp"] == linked["_fp"], "left")
    by_fp = by_fp.select(F.col("fp").alias("_fp"), F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(by_fp, fps["fp"] == by_fp["_fp"]).select("doc_id", "fp", "component_id", "component", "text_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, and
    of several texts under it the one with the smallest ``text_id``.

    A document is a doc_id with its text, so rows that repeat a doc_id with
    another text are judged by their own fingerprint, and of rows equal in
    both one stays (the least by a hash of all its columns).  Rows without a
    doc_id stay as they are.  The result does not depend on the order of the
    rows."""
    scratch = Scratch(docs.sparkSession, "simhash-one")
    doc, name, times = (fresh(docs, c) for c in ("_doc", "_name", "_times"))
    own = near_duplicates(docs, shingle, max_bits).where("doc_id = component_id")
    rows = own.groupBy("component", "doc_id", "text_id").agg(F.count(F.lit(1)).alias("n"))
    reps = rows.groupBy("component").agg(F.min(F.struct("text_id", "doc_id", "n")).alias("s"))
    reps = scratch.save(reps.select(F.col("s.doc_id").alias(doc), F.col("s.text_id").alias(name), F.col("s.n").alias(times)), "reps")
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (text_id(F.col("text")) == F.col(name))
    kept = docs.join(broadcast_if_small(reps, reps.count(), BROADCAST_ROWS), same)
    order = Window.partitionBy(doc, name).orderBy(F.xxhash64(*docs.columns))
    repeated = kept.where(F.col(times) > 1).withColumn(times, F.row_number().over(order)).where(F.col(times) == 1)
    return kept.where(F.col(times) == 1).unionAll(repeated).select(*docs.columns).unionAll(docs.where("doc_id is null"))
