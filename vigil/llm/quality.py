"""Quality rules on repetition inside a document, by suffix array.

A chunk of documents is one sequence of word numbers (numbered per document,
so equal words of two documents differ).  Prefix doubling
sorts its suffixes; only groups that still tie are sorted again, so a clean
text costs two or three short sorts.  The rank groups of every doubling are
kept and give the exact longest common prefix of neighbours in the suffix
array.  Neighbours with a common prefix of at least ``min_words`` words bound
the LCP intervals; the left-maximal ones are the maximal repeated substrings.
The union of their occurrences is what repetition covers.

A document is kept if it passes the base rules and if

* repeats cover at most ``max_covered`` of its word characters, and
* no single repeat is longer than ``max_longest`` words or, in shorter
  documents, than ``max_longest_part`` of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm.common import bounded_batches, chunks

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class QualityRules:
    min_doc_words: int = 20
    min_words: int = 8
    max_repeat_percent: int = 30
    max_covered: float = 0.4
    max_longest: int = 1000
    max_longest_part: float = 0.25


def suffix_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word position the length, in words, of the longest substring
    starting there that occurs at another position of the same document.

    ``ids``: word numbers, no number shared by two documents; ``doc``: the
    document of each word, ascending.
    """
    n = len(ids)
    if n < 2:
        return np.zeros(n, np.int64)
    act = np.argsort(ids)
    key = ids[act]
    # the rank of a suffix: place of the first member of its group
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, n))
    rank[act] = np.repeat(starts, sizes)
    order = act.copy()
    last = np.append(np.flatnonzero(doc[1:] != doc[:-1]), n - 1)  # of each document
    doc_end = np.repeat(last + 1, np.diff(np.concatenate(([-1], last))))
    levels = []
    length = 1
    act = act[np.repeat(sizes > 1, sizes)]
    while len(act):
        at = np.sort(act)
        levels.append((length, at, rank[at]))
        nxt = act + length
        inside = nxt < doc_end[act]
        # a document's end sorts first; no two suffixes of it end at one place
        key2 = np.where(inside, rank[np.minimum(nxt, n)], -1)
        key = rank[act] * (n + 2) + key2 + 1
        o = np.argsort(key)
        act, key = act[o], key[o]
        r = rank[act]
        new_old = np.concatenate(([True], r[1:] != r[:-1]))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(act)))
        base = np.maximum.accumulate(np.where(new_old, np.arange(len(act)), 0))
        place = r + np.arange(len(act)) - base
        order[place] = act
        rank[act] = np.repeat(place[starts], sizes)
        act = act[np.repeat(sizes > 1, sizes)]
        length *= 2
    # neighbours in the suffix array: binary lifting over the kept groups
    p, q = order[:-1], order[1:]
    if not levels:
        return np.zeros(n, np.int64)
    _, at0, r0 = levels[0]
    full = np.full(n, -1, np.int64)
    full[at0] = r0
    cand = np.flatnonzero((full[p] == full[q]) & (full[p] >= 0))
    p, q, lcp = p[cand], q[cand], np.zeros(len(cand), np.int64)
    for length, at, r in reversed(levels):
        lcp += length * _same(at, r, p + lcp, q + lcp)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, p, lcp)
    np.maximum.at(longest, q, lcp)
    return longest


def _same(at: np.ndarray, r: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    i = np.minimum(np.searchsorted(at, p), len(at) - 1)
    j = np.minimum(np.searchsorted(at, q), len(at) - 1)
    return (at[i] == p) & (at[j] == q) & (r[i] == r[j])


def _union(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions that spans cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


COLUMNS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("covered_chars", pa.int64()), ("longest_repeat", pa.int64()), ("n_repeats", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
]
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_chars long, longest_repeat long, n_repeats long, base_failed boolean, kept boolean"


def measure(texts: list[str], rules: QualityRules) -> list[tuple]:
    """The values of ``COLUMNS`` for each text."""
    ids, sizes, chars, rows, total = [], [], [], [], 0
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").split()
        # words of one document are equal if their 64-bit hashes are
        h = np.fromiter(map(hash, words), np.int64, len(words))
        distinct, inverse = np.unique(h, return_inverse=True)
        ids.append(inverse + total)
        total += len(distinct)
        sizes.append(len(words))
        text_words = len(t) - sum(t.count(c) for c in SPACES)
        lines = [x for x in t.split("\n") if x.strip(SPACES)] if "\n" in t else []
        rows.append([len(words), text_words, sum(t.count(c) for c in SYMBOLS), len(lines) - len(set(lines))])
        # bytes of a word stand for its characters in the covered part
        chars.append(np.fromiter(map(len, words), np.int64, len(words)))
    doc = np.repeat(np.arange(len(texts)), sizes)
    longest = suffix_repeats(np.concatenate(ids) if ids else np.zeros(0, np.int64), doc)
    width = np.concatenate(chars) if chars else np.zeros(0, np.int64)
    # maximal: not the tail of the repeat that starts one word before
    hit = longest >= rules.min_words
    tail = np.zeros(len(longest), bool)
    tail[1:] = (longest[:-1] == longest[1:] + 1) & (doc[:-1] == doc[1:])
    start = np.flatnonzero(hit & ~tail)
    cover = _union(start, start + longest[start], len(longest))
    ends = np.cumsum(sizes)
    out = []
    for i, (n_words, word_chars, n_symbols, n_dup) in enumerate(rows):
        s = slice(ends[i] - sizes[i], ends[i])
        n_rep, top = int(cover[s].sum()), int(longest[s].max(initial=0))
        top = top if top >= rules.min_words else 0
        n_bytes = int(width[s].sum())
        covered = word_chars if n_rep == n_words else int(width[s][cover[s]].sum()) * word_chars // max(1, n_bytes)
        failed = n_words < rules.min_doc_words or 100 * n_rep > rules.max_repeat_percent * n_words
        good = covered <= rules.max_covered * word_chars and top <= max(rules.min_words * 2, min(rules.max_longest, rules.max_longest_part * n_words))
        n_repeats = int((hit & ~tail)[s].sum())
        out.append((n_words, word_chars, n_symbols, n_dup, n_rep, covered, top, n_repeats, failed, good and not failed))
    return out


def repetition(docs: DataFrame, rules: QualityRules = QualityRules(), columns: list[str] | None = None) -> DataFrame:
    """The given ``columns`` of each row (default doc_id) with the measures
    of ``COLUMNS``: one row per input row, in one pass and without a shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``.  Null and wordless texts have zero
    everywhere and fail the base rules; repeated rows are measured alike;
    other columns, whatever their names, are ignored; an empty table gives an
    empty table.  ``covered_chars`` is in code points, pro rata to the bytes.
    A text is handled by one task in memory linear in its words.
    """
    bounded_batches(docs.sparkSession)
    keep = columns or ["doc_id"]
    names = [f"c{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or "" for x in b.column(b.num_columns - 1).to_pylist()]
            rows = [r for part in chunks(texts, lambda t: len(t) + 64, CHUNK_BYTES) for r in measure(part, rules)]
            got = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(COLUMNS)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *got], [*names, *(c for c, _ in COLUMNS)])

    src = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], docs["text"].cast("string").alias("text_"))
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    out = src.mapInArrow(run, f"{kinds}, {SCHEMA}")
    for c, n in zip(keep, names):
        out = out.withColumnRenamed(n, c)
    return out


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs``, with their columns, that the rules keep.

    One pass: measures and the verdict are made beside the row, so nothing
    is joined back."""
    bounded_batches(docs.sparkSession)
    schema = docs.schema
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x or "" for x in b.column(place).to_pylist()]
            kept = [r[-1] for part in chunks(texts, lambda t: len(t) + 64, CHUNK_BYTES) for r in measure(part, rules)]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, schema)
