from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import SF, docs_df, sf_table
from tokenizers import Tokenizer

from vigil.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Hello <|endoftext|>it's  fine\tx\x1cy\x85z á  b ΣΑΣ don't 'll", "<|startoftext|>", "", " ", "\n\n", "a\x00b 123 4.5 €", "İstanbul ǅ ﬁ  x", "où ça!? x,y ..", "ÿ÷ß ªº µ", "été ́x", "１２ ⅷ", "a.'s b,'t"]


def ids_of(text, t=Tokenizer.from_file(PATH)):
    return t.encode(text, add_special_tokens=False).ids


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity
    return bins


def test_cached_ids_equal_those_of_whole_texts():
    w = packing.WordTokenizer(PATH)
    for text in ODD + [d["text"] or "" for d in sf_table("documents")[:150]]:
        assert np.frombuffer(w.ids(text), "<u4").tolist() == ids_of(text), text[:80]


def test_whole_table(spark):
    rows = queries.op3_residual_packing(spark, SF).collect()
    bins = check_places(rows, 2048)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for d in sf_table("documents"):
        ids = np.array([*ids_of(d["text"] or ""), 0], "<u4")
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[d["doc_id"]])
        parts = [ids[i : i + 2048] for i in range(0, len(ids), 2048)]
        assert got == [(k, 2048 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
    total = sum(r.length for r in rows)
    assert len(bins) <= 1.01 * -(-total // 2048) + 1


def test_rounds_join_what_tasks_leave(spark):
    rows = [(i, "word " * (5 + i % 40)) for i in range(400)]
    out = packing.pack(docs_df(spark, rows).repartition(16), capacity=64, slack=2, task_items=20).collect()
    bins = check_places(out, 64)
    assert len(bins) <= 1.1 * -(-sum(r.length for r in out) // 64)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fill = packing.best_fit(np.array([6, 7, 3, 4]), np.arange(4), 10)
    assert bins.tolist() == [0, 1, 1, 0] and offsets.tolist() == [0, 0, 7, 6] and fill == [10, 10]


def test_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "x y"), (3, "word " * 5000)]
    out = packing.pack(docs_df(spark, rows), with_ids=True).collect()
    check_places(out, 2048)
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in out) == [(0, 0, 3), (1, 0, 1), (2, 0, 1), (2, 0, 1), (3, 0, 2048), (3, 1, 2048), (3, 2, 905)]
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out)
    assert packing.pack(docs_df(spark, rows).limit(0)).count() == 0
