"""Alignment of two tokenizers' tokens by interval coalescing.

Per text both token sequences tile the same bytes.  All tokens of a block of
texts are one set of intervals on one byte axis: sorted by start (lexsort),
their ends accumulated to a running maximum, a group of tokens breaks where a
start reaches that maximum; overlapping A and B tokens are expanded within
the groups.  Links are the overlaps that end together.

Corpus figures of id pairs (how often linked, which is the highest of its B
id) are counted over all texts: per text the distinct pairs with their times
go to a scratch table, then are summed.  To bring the figures back, pairs
that hold at least one part in ``HOT`` of all links are broadcast (there are
at most ``HOT`` of them, so they are bounded at every size) and looked up
inside the scan; the other pairs, of which none has a large part of the
rows, are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm.bytebpe import CACHE_CHARS, CACHE_ENTRIES, Pretokens, byte_strings, prove_whole
from vigil.llm.common import Scratch, bounded_batches, chunks

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs that are broadcast: at most so many can each hold 1 / HOT of the links.
HOT = 250_000
#: Bytes of texts whose tokens are aligned at once (a longer text: alone).
BLOCK_BYTES = 1_000_000


class ByteTokenizer(dict):
    """Ids of byte-level BPE, special tokens' strings as plain text; a
    pre-token that is proven whole needs no merge."""

    def __init__(self, path: str, whole: dict[str, int]):
        self.pre, self.whole = Pretokens(Tokenizer.from_file(path)), whole
        self.bytes = byte_strings(self.pre.tokenizer)
        self._start()

    def _start(self) -> None:
        self.update({w: np.uint32(i).tobytes() for w, i in self.whole.items()})
        self.first = len(self)

    def __missing__(self, piece: str) -> bytes:
        got = array("I", [t.id for t in self.pre.merge(piece)]).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.first + CACHE_ENTRIES:
                self.clear()
                self._start()
            self[piece] = got
        return got

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.pre.of(text))), np.uint32).astype(np.int64)


class PieceTokenizer:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.bytes = {i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number of every interval: sorted by start, a group breaks where a
    start reaches the running maximum of the ends before it."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    groups = np.empty(len(order), np.int64)
    groups[order] = np.cumsum(breaks) - 1
    return groups


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B interval that share a byte; each side is
    sorted and without overlaps of its own."""
    first = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - first
    a = np.repeat(np.arange(len(a_start)), n)
    within = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    return a, first[a] + within


class Aligner:
    def __init__(self, a: ByteTokenizer, b: PieceTokenizer):
        self.a, self.b = a, b
        self.a_len, self.b_len = _lengths(a.bytes), _lengths(b.bytes)
        size = max(len(self.a_len), len(self.b_len))
        # "," ";" or "|" with every id, and the lengths of these strings
        self.shown = np.array([sep + str(i).encode() for sep in (b",", b";", b"|") for i in range(size)], object)
        self.shown_len = np.array([len(x) for x in self.shown], np.int64)
        self.size = size

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text the ids of both sides; none where the bytes differ."""
        none = np.zeros(0, np.int64)
        out = []
        for text, b in zip(texts, self.b.ids(texts)):
            whole = (" " + text).encode()
            a = self.a.ids(" " + text) if text else none
            same = text and b"".join(map(self.a.bytes.__getitem__, a.tolist())) == whole and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == whole
            out.append((a, b) if same else (none, none))
        return out

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Figures, digest and links of every text."""
        both = self.tokens(texts)
        n_a, n_b = (np.array([len(x[k]) for x in both], np.int64) for k in (0, 1))
        a, b = (np.concatenate([x[k] for x in both]) for k in (0, 1))
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_start, b_start = a_end - self.a_len[a], b_end - self.b_len[b]
        # texts follow each other on the byte axis, so no group spans two
        groups = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
        ga, gb = groups[: len(a)], groups[len(a) :]
        ai, bj = overlaps(a_start, a_end, b_start, b_end)
        linked = a_end[ai] == b_end[bj]
        doc_a = np.repeat(np.arange(len(texts)), n_a)
        doc_link = doc_a[ai[linked]]
        pairs = (a[ai[linked]] << 32) | b[bj[linked]]
        first_a, first_b = _firsts(ga), _firsts(gb)
        n_docs = len(texts)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(doc_a[first_a], minlength=n_docs),
            "n_links": np.bincount(doc_link, minlength=n_docs),
            "n_overlaps": np.bincount(doc_a[ai], minlength=n_docs),
            "groups_sha256": self._digests(a, b, ga, gb, first_a, first_b, n_a, n_b),
            "pairs": [np.unique(p, return_counts=True) for p in np.split(pairs, np.searchsorted(doc_link, np.arange(1, n_docs)))],
        }

    def _digests(self, a, b, ga, gb, first_a, first_b, n_a, n_b) -> list[str]:
        """SHA-256 of each text's groups: A ids, ``|``, B ids, between ``;``."""
        at = np.empty(len(a) + len(b), np.int64)
        at[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = a + self.size * first_a
        at[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = b + 2 * self.size * first_b
        text = b"".join(self.shown[at].tolist())
        ends = np.concatenate([[0], np.cumsum(self.shown_len[at])])
        bounds = ends[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        return [hashlib.sha256(text[lo + 1 : hi]).hexdigest() if hi > lo else "" for lo, hi in zip(bounds, bounds[1:])]


def _lengths(table: dict[int, bytes]) -> np.ndarray:
    return np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], np.int64)


def _firsts(groups: np.ndarray) -> np.ndarray:
    first = np.ones(len(groups), bool)
    first[1:] = groups[1:] != groups[:-1]
    return first


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a: str, b: str, whole: dict[str, int]) -> Aligner:
    """One aligner per Python worker, kept between its tasks."""
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(ByteTokenizer(public_tokenizers.path(a), whole), PieceTokenizer(public_tokenizers.path(b)))
    return _ALIGNERS[a, b]


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
ALIGNED = "row long, doc_id long, " + ", ".join(f"{c} long" for c in FIGURES) + ", groups_sha256 string, pair array<long>, times array<long>"


def align_texts(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY) -> DataFrame:
    """One row per input row: figures, digest, and the distinct linked id
    pairs (A id * 2**32 + B id) with their times.  ``row`` numbers the rows
    of one run."""
    spark = docs.sparkSession
    bounded_batches(spark)
    whole = spark.sparkContext.broadcast(prove_whole(public_tokenizers.path(a)))  # at most the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b, whole.value)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (t or "" for t in batch.column(1).to_pylist()))
            for part in chunks(rows, lambda r: len(r[1]), BLOCK_BYTES):
                out = aligner.align([t for _, t in part])
                pairs = out["pairs"]
                offsets = pa.array(np.cumsum([0, *(len(p) for p, _ in pairs)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[k] for x in pairs]), pa.int64())) for k in (0, 1)]
                figures = [pa.array(out[c], pa.int64()) for c in FIGURES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(part))), pa.array([d for d, _ in part], pa.int64()), *figures, pa.array(out["groups_sha256"], pa.string()), *lists],
                    ["row", "doc_id", *FIGURES, "groups_sha256", "pair", "times"],
                )
                row += len(part)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, scratch: Scratch) -> DataFrame:
    """(pair, n, best): links of each id pair in the corpus, and whether no
    pair with the same B id has more."""
    flat = aligned.select(F.explode(F.arrays_zip("pair", "times")).alias("p")).select("p.pair", "p.times")
    counts = scratch.save(flat.groupBy("pair").agg(F.sum("times").alias("n")), "counts")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    return scratch.save(counts.join(most, b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).alias("best")), "ranked")


def alignment(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum,
    groups_sha256): one row per input row.

    A encodes a space and the text, B the text (it adds the space itself).
    Texts that are null or empty, or whose joined token bytes differ from
    space + text on either side, have no tokens: zeros and an empty digest.
    Rows that repeat a doc_id or have none are rows of their own; other
    columns are ignored; an empty table gives an empty table."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    aligned = scratch.save(align_texts(docs, a, b), "aligned")
    ranked = pair_counts(aligned, scratch)
    total = ranked.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * hot >= total
    top = ranked.where(often).toArrow()  # at most ``hot`` rows
    pair = top["pair"].to_numpy()
    order = np.argsort(pair)
    known = spark.sparkContext.broadcast((pair[order], top["n"].to_numpy()[order], top["best"].to_numpy().astype(np.int64)[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = known.value
        for batch in batches:
            lists, times = batch.column("pair"), batch.column("times").flatten().to_numpy()
            p = lists.flatten().to_numpy()
            doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pairs, p), max(len(pairs) - 1, 0))
            hit = pairs[at] == p if len(pairs) else np.zeros(len(p), bool)
            at = at[hit]
            n_best, total_n = (_sums(doc[hit], v * times[hit], len(lists)) for v in (best[at], counts[at]))
            cold = np.concatenate([[0], np.cumsum(np.bincount(doc[~hit], minlength=len(lists)))])
            rest = [pa.ListArray.from_arrays(pa.array(cold, pa.int32()), pa.array(x[~hit], pa.int64())) for x in (p, times)]
            kept = [batch.column(c) for c in ["row", "doc_id", *FIGURES, "groups_sha256"]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(total_n), *rest], ["row", "doc_id", *FIGURES, "groups_sha256", "n_best", "count_sum", "pair", "times"])

    schema = ALIGNED.replace("pair array", "n_best long, count_sum long, pair array")
    looked = aligned.mapInArrow(look_up, schema)
    flat = looked.select("row", F.explode(F.arrays_zip("pair", "times")).alias("p")).select(F.col("row").alias("_row"), "p.pair", "p.times")
    found = flat.join(ranked.where(~often).withColumnRenamed("pair", "_pair"), F.col("pair") == F.col("_pair"))
    found = found.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("times")).alias("_sum"))
    out = looked.drop("pair", "times").join(found, F.col("row") == F.col("_row"), "left")
    n_best, count_sum = (F.col(x) + F.coalesce(F.col(y), F.lit(0)) for x, y in (("n_best", "_best"), ("count_sum", "_sum")))
    return out.select("doc_id", *FIGURES, n_best.alias("n_best"), count_sum.alias("count_sum"), "groups_sha256")


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums per position (``bincount`` would add in floating point)."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out
