"""Best-fit packing of tokenised documents by hierarchical residual packing.

Round 0: every scan task tokenises its documents, cuts the long ones and packs
its pieces best-fit decreasing.  Nearly full bins (residual at most
``slack``) are final; the underfull ones become items of their fill.  Every
later round deals the remaining bins to fewer tasks, which pack them best-fit
again (a bin as one item keeps its inner order).  Rounds go on until one
round joins hardly any bins.  No round gives a task more than about
``task_items`` items, so no task grows with the corpus.

A bin is 40 bytes: only round 0 sees texts, and tokens never leave its tasks
unless asked for.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from vigil.llm.common import Scratch, bounded_batches

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 1_000_000


class WordTokenizer(dict):
    """Token ids of whole texts through a cache of space-separated words.

    The tokenizer drops white space and never joins text across it, so the
    ids of a text are those of its words in order.  A lower-case word of
    Latin-1 letters is one pre-token, and so is the punctuation after it:
    both go straight to the tokenizer's model; any other word goes through
    the whole tokenizer.  A test compares the ids with those of whole texts.
    """

    simple = re.compile("([a-zà-öø-ÿ]+)([,.!?;:%&$#*|]*)")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        m = self.simple.fullmatch(word)
        if not m:
            got = self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        elif m[2]:
            got = self[m[1]] + self[m[2]]
        else:
            shown = word if word.isascii() else self.as_bytes(word)[0][0]
            got = self._packed([t.id for t in self.model.tokenize(shown)])
        if len(self) >= CACHE_WORDS:
            self.clear()
            self[""] = b""
        self[word] = got
        return got

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if text.isascii() or _is_latin1(text):
            text = text.lower()  # as the tokenizer does, so that the cache holds one form
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and cache per Python worker, kept between its tasks."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit placement of items taken in ``order``: (bin and offset of
    each item, fill of each bin).

    The open bins are kept by residual; a bit mask of the residuals in use
    gives the tightest bin that fits in constant time."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order.tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        if room > n:
            by_room[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, offsets, fill


def _bin_ids(round_no: int, local: np.ndarray) -> np.ndarray:
    """Bin numbers unique over rounds and tasks (4 bits, 27 bits, 32 bits)."""
    return (np.int64(round_no) << 59) + (np.int64(TaskContext.get().partitionId()) << 32) + local


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, at long, fill long"


def _pack_documents(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cols = word_tokenizer(path), [[] for _ in range(5)]
        ids = []
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for doc, text in zip(b.column(0).to_pylist(), texts):
                got = words.ids(text) + end
                for piece, s in enumerate(range(0, len(got), 4 * capacity)):
                    part = got[s : s + 4 * capacity]
                    for c, v in zip(cols, (doc, piece, s // 4, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
                    if with_ids:
                        ids.append(part)
        lengths = np.array(cols[3], np.int64)
        if not len(lengths):
            return
        tie = np.array([-1 if d is None else d for d in cols[0]], np.int64)
        bins, offsets, fill = best_fit(lengths, np.lexsort((cols[1], tie, -lengths)), capacity)
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])]
        arrays += [pa.array(_bin_ids(0, bins)), pa.array(offsets), pa.array(np.array(fill, np.int64)[bins])]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "at", "fill"]
        if with_ids:
            arrays.append(pa.array(ids, pa.binary()))
            names.append("ids")
        whole = pa.Table.from_arrays(arrays, names)
        yield from whole.to_batches(max_chunksize=65536)

    return run


def _merge_bins(round_no: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not parts:
            return
        child, length = (np.concatenate(x) for x in zip(*parts))
        bins, offsets, fill = best_fit(length, np.lexsort((child, -length)), capacity)
        yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(_bin_ids(round_no, bins)), pa.array(offsets), pa.array(np.array(fill, np.int64)[bins])], ["child", "bin", "at", "fill"])

    return run


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    slack: int = 16,
    vocabulary: str | None = None,
    end_id: int = 0,
    task_items: int = 50_000,
    max_rounds: int = 6,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (and ``ids``, little-endian unsigned 32-bit, on
    request).

    A document is its token ids and then ``end_id``; only longer ones are
    cut, into pieces of ``capacity``.  Null and empty texts are one piece of
    one id.  Repeated rows are packed as often as given, ties in length go
    by doc_id and piece, a null doc_id is carried through, other columns are
    ignored, an empty table gives an empty table.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "packing")
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    pieces = scratch.save(src.mapInArrow(_pack_documents(path, capacity, end_id, with_ids), PIECES + (", ids binary" if with_ids else "")), "pieces")
    # where each bin of the last round ended: (bin, root, base)
    open_bins = pieces.where(F.col("at") == 0).select("bin", "fill").where(F.col("fill") < capacity - slack)
    moves = []
    for r in range(1, max_rounds + 1):
        open_bins = scratch.save(open_bins, f"open{r}")
        n = open_bins.count()
        if n < 2:
            break
        tasks = -(-n // task_items)
        # other neighbours each round: the deal is a hash of the bin number
        dealt = open_bins.select(F.col("bin").alias("child"), "fill").repartition(tasks, F.xxhash64("child", F.lit(r)))
        merged = scratch.save(dealt.mapInArrow(_merge_bins(r, capacity), "child long, bin long, at long, fill long"), f"round{r}")
        moves.append(merged)
        roots = merged.where(F.col("at") == 0)
        left = roots.count()
        if n - left < max(1, n // 100):
            break
        open_bins = roots.select("bin", "fill").where(F.col("fill") < capacity - slack)
    # a piece's place: the chain of its bin's moves
    out = pieces.select("*", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    for m in moves:
        m = m.select(F.col("child").alias("_child"), F.col("bin").alias("_bin"), F.col("at").alias("_at"))
        out = out.join(m, out["sequence_id"] == m["_child"], "left").withColumns({"sequence_id": F.coalesce("_bin", "sequence_id"), "offset": F.col("offset") + F.coalesce("_at", F.lit(0))}).drop("_child", "_bin", "_at")
    return out.drop("bin", "at", "fill")
