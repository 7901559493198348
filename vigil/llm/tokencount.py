"""Token counts by the whole-token shortcut.

``prove_whole`` (bytebpe.py) proves once, on the driver, which vocabulary
strings encode alone as one token; the proven strings (at most the
vocabulary) are broadcast.  Tasks split texts into pre-tokens: a proven one
counts as one token without any merge, only the rest are merged, each
distinct one once per cache.  One pass over the texts, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm.bytebpe import CACHE_CHARS, CACHE_ENTRIES, Pretokens, is_byte_level, prove_whole
from vigil.llm.common import bounded_batches

VOCABULARY = "byte_bpe_50k.json"


class _Costs(dict):
    """Tokens of a pre-token: proven ones are there, others are merged."""

    def __init__(self, whole, pre: Pretokens):
        super().__init__(dict.fromkeys(whole, 1))
        self.pre, self.whole, self.merged = pre, len(self), 0
        self.proven = whole

    def __missing__(self, piece: str) -> int:
        self.merged += 1
        n = len(self.pre.merge(piece))
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.whole + CACHE_ENTRIES:
                self.clear()
                self.update(dict.fromkeys(self.proven, 1))
            self[piece] = n
        return n


class Counter:
    """Counts tokens as ``Tokenizer.encode(text, add_special_tokens=False)``
    does: the strings of special tokens inside a text are one token each."""

    def __init__(self, path: str, whole):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pre = Pretokens(self.tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.costs = _Costs(whole, self.pre)

    def count(self, text: str) -> int:
        found = [s for s in self.special if s in text]
        if len(found) > 1:  # which of several comes first is the library's rule
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = text.split(found[0]) if found else [text]
        return len(parts) - 1 + sum(sum(map(self.costs.__getitem__, self.pre.of(p))) for p in parts)


class LibraryCounter:
    """Vocabularies without byte-level pre-tokens: every text is encoded."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda text: len(model.encode(text))
        else:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.count = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


_COUNTERS: dict[str, Counter | LibraryCounter] = {}


def _counter(path: str, whole):
    """One counter per Python worker, kept between its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path, whole.value) if whole is not None else LibraryCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole ``text``.

    ``vocabulary`` is a file of the tokenizers folder.  A null text is empty:
    zeros.  Every row gives a row, also those that repeat a doc_id or have
    none; other columns are ignored; an empty table gives an empty table."""
    spark = docs.sparkSession
    bounded_batches(spark)
    path = public_tokenizers.path(vocabulary)
    byte_level = path.endswith(".json") and is_byte_level(Tokenizer.from_file(path))
    # at most one string per entry of the vocabulary
    whole = spark.sparkContext.broadcast(sorted(prove_whole(path))) if byte_level else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(public_tokenizers.path(vocabulary), whole).count
        for batch in batches:
            texts = batch.column(1)
            n = pa.array([count(t) if t else 0 for t in texts.to_pylist()], pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
